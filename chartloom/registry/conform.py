"""Cleaning, deduplication, terminology."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.text import clean_id
from chartloom.operators import conform as ops
from chartloom.registry import roles


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def reference_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = roles.table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{roles.DIRTY_REFERENCE} AS reference"
    )
    return dirty.select("event_id", clean_id(F.col("reference")).alias("patient_fhir_id"))


def column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted columns, some of which the table lacks; the reference column by what exists."""
    lines = roles.table(spark, sf_dir, "lineitem")
    lines = lines.withColumnRenamed("l_suppkey", "patient_reference")
    reference = ops.reference_column(lines)
    wanted = ["l_orderkey", "l_linenumber", "l_colour", "l_quantity", "l_weight", reference]
    return ops.pick(lines, wanted)


def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line per order and line number: by date, then by all that tells lines apart."""
    return ops.keep_first(roles.table(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_ORDER)


def terminology_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.terminology(roles.observations(spark, sf_dir), ["event_id"])


def terminology_dim_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatible form: missing codes are the text ``nan``."""
    staged = roles.observations(spark, sf_dir)
    return ops.terminology(ops.clean_observations(staged, null_code="nan"), ["event_id"])


QUERIES = {
    "reference_cleanup": reference_cleanup,
    "column_subset": column_subset,
    "dedup_keep_first": dedup_keep_first,
    "terminology_dim": terminology_dim,
    "terminology_dim_nan": terminology_dim_nan,
}
_FIRST = f"""
WITH obs AS ({roles.OBSERVATION_SQL}),
first AS (SELECT loinc_code, display_name,
                 row_number() OVER (PARTITION BY loinc_code ORDER BY event_id) AS rn FROM obs)"""
SQL = {
    "reference_cleanup": f"""
SELECT event_id, replace(replace(
         trim({roles.DIRTY_REFERENCE}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'Patient/', ''), 'urn:uuid:', '') AS patient_fhir_id
FROM events""",
    "column_subset": """
SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey AS patient_reference FROM lineitem""",
    "dedup_keep_first": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(_LINE_KEY)}
                               ORDER BY {', '.join(_LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""",
    "terminology_dim": f"""{_FIRST}
SELECT loinc_code, coalesce(display_name, 'Unknown Display Name') AS display_name
FROM first WHERE rn = 1""",
    "terminology_dim_nan": f"""{_FIRST}
SELECT coalesce(loinc_code, 'nan') AS loinc_code,
       coalesce(display_name, 'Unknown Display Name') AS display_name
FROM first WHERE rn = 1""",
}
