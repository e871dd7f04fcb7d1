"""Bundles to resources to flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.schemas import ADDRESSES, CODINGS

_SOURCE = ["src_file", "src_path", "src_offset", "src_row", "bundle_id"]


def entry_counts(bundles: DataFrame) -> DataFrame:
    """Entries per bundle; a bundle without ``entry`` has none."""
    return bundles.select(*_SOURCE, F.coalesce(F.array_size("entry"), F.lit(0)).alias("n_entries"))


def _first(raw: str, schema: str, field: str) -> Column:
    """A field of the first element of a list in raw text; what is not a list has none."""
    is_list = F.col(raw).startswith("[")
    return F.when(is_list, F.get(F.from_json(raw, schema), F.lit(0)).getField(field))


def _explode(bundles: DataFrame, entries: Column) -> DataFrame:
    # The outer form keeps one row for a corrupt bundle.
    return bundles.select(
        *_SOURCE, "corrupt", F.posexplode_outer(entries).alias("src_pos", "e")
    ).select(*_SOURCE, "src_pos", "corrupt", "e.resource.*")


def resources(bundles: DataFrame) -> DataFrame:
    """One row per entry with its resource fields; also one per corrupt or empty bundle, with no
    type, which every filter on the type drops."""
    return _explode(bundles, F.col("entry"))


def sample_resources(bundles: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` entries of every bundle."""
    return _explode(bundles, F.slice("entry", 1, n)).filter(F.col("src_pos").isNotNull())


def of_type(df: DataFrame, resource_type: str) -> DataFrame:
    return df.filter(F.col("resourceType") == resource_type)


def patient_fields() -> list[Column]:
    return [
        F.col("id").alias("patient_fhir_id"),
        F.col("gender"),
        F.col("birthDate").alias("birth_date"),
        _first("address", ADDRESSES, "postalCode").alias("postal_code"),
    ]


def observation_fields() -> list[Column]:
    return [
        F.col("id").alias("obs_id"),
        F.col("subject.reference").alias("patient_reference"),
        _first("code.coding", CODINGS, "code").alias("loinc_code"),
        _first("code.coding", CODINGS, "display").alias("display_name"),
        F.col("valueQuantity.value").alias("result_value"),
        F.col("valueQuantity.unit").alias("unit"),
        F.coalesce("effectiveDateTime", "issued").alias("effective_datetime"),
    ]
