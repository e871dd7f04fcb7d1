"""Bundles landed as VARIANT: parsed once, when they are landed; every field is a path afterwards.

A variant tells a key that is absent from one that is JSON null, where a schema knows NULL only. That
decides a fallback: an ``effectiveDateTime`` that is there as null is the answer, one that is not there
is looked for in ``issued``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KINDS = "resource_type STRING, page BIGINT, bundle VARIANT"


def land_variants(pages: DataFrame, path: str) -> None:
    """Land raw bundles (``resource_type, page, payload``) as variants; text that is no JSON as NULL."""
    bundle = F.try_parse_json(F.col("payload").cast("string")).alias("bundle")
    landed = pages.select(F.lower("resource_type").alias("resource_type"), F.col("page").cast("bigint").alias("page"), bundle)
    landed.write.mode("overwrite").parquet(path)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_KINDS).parquet(path)


def field(value: str, path: str, kind: str = "string") -> Column:
    """A field by its path, NULL where it is absent, JSON null or of another kind."""
    return F.try_variant_get(F.col(value), path, kind)


def present(value: str, path: str) -> Column:
    """Whether there is such a key, with JSON null or any other value."""
    return F.try_variant_get(F.col(value), path, "variant").isNotNull()


def variant_entries(landed: DataFrame) -> DataFrame:
    """One row per entry: ``resource_type, page, src_pos, resource``; a bundle whose ``entry`` is no list has
    none."""
    entries = F.try_variant_get("bundle", "$.entry", "array<variant>")
    found = landed.select("resource_type", "page", F.posexplode(entries).alias("src_pos", "e"))
    return found.select("resource_type", "page", "src_pos", F.try_variant_get("e", "$.resource", "variant").alias("resource"))


def variant_patients(entries: DataFrame) -> DataFrame:
    patient = field("resource", "$.resourceType") == "Patient"
    return entries.where(patient).select(
        "page",
        "src_pos",
        field("resource", "$.id").alias("patient_fhir_id"),
        field("resource", "$.gender").alias("gender"),
        field("resource", "$.birthDate").alias("birth_date"),
        field("resource", "$.address[0].postalCode").alias("postal_code"),
    )


def variant_observations(entries: DataFrame) -> DataFrame:
    observation = field("resource", "$.resourceType") == "Observation"
    effective, issued = "$.effectiveDateTime", "$.issued"
    return entries.where(observation).select(
        "page",
        "src_pos",
        field("resource", "$.id").alias("obs_id"),
        field("resource", "$.subject.reference").alias("patient_reference"),
        field("resource", "$.code.coding[0].code").alias("loinc_code"),
        field("resource", "$.code.coding[0].display").alias("display_name"),
        field("resource", "$.valueQuantity.value", "double").alias("result_value"),
        field("resource", "$.valueQuantity.unit").alias("unit"),
        F.when(present("resource", effective), field("resource", effective))
        .otherwise(field("resource", issued))
        .alias("effective_datetime"),
    )
