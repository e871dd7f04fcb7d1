"""Cleaning, keep-first deduplication and the terminology dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.functions.text import clean_id, trim_blanks
from chartloom.functions.typed import to_number

UNKNOWN_DISPLAY = "Unknown Display Name"


def pick(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those wanted columns that exist."""
    return df.select([c for c in wanted if c in df.columns])


def reference_column(df: DataFrame) -> str:
    return "patient_reference" if "patient_reference" in df.columns else "patient_fhir_id"


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order``. NULL is a key like any other.

    Each task reduces a key to one row before the shuffle (window group limit), so a hot key
    reaches its final task with at most one row per task.
    """
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def clean_patients(staged: DataFrame) -> DataFrame:
    return staged.withColumn("patient_fhir_id", clean_id(F.col("patient_fhir_id")))


def clean_observations(staged: DataFrame, null_code: str | None = None) -> DataFrame:
    """Ids and codes trimmed, reference prefixes removed, values as numbers.

    ``null_code`` writes missing codes as that text; by default they stay NULL.
    """
    code = trim_blanks(F.col("loinc_code"))
    if null_code is not None:
        code = F.coalesce(code, F.lit(null_code))
    return staged.withColumns(
        {
            "obs_id": trim_blanks(F.col("obs_id")),
            "patient_fhir_id": clean_id(F.col(reference_column(staged))),
            "loinc_code": code,
            "result_value": to_number(F.col("result_value")),
        }
    )


def terminology(observations: DataFrame, order: list[str]) -> DataFrame:
    """Distinct code with its first display, which may be missing, then the fill text.

    Two steps: the earliest row per (code, display) in one combining aggregate over all rows, then
    the first of these few per code. Codes may be as skewed as they like.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    earliest = observations.groupBy("loinc_code", "display_name").agg(
        F.min(position).alias("_position")
    )
    return (
        earliest.groupBy("loinc_code")
        .agg(F.min(F.struct("_position", "display_name")).alias("_first"))
        .select(
            "loinc_code",
            F.coalesce("_first.display_name", F.lit(UNKNOWN_DISPLAY)).alias("display_name"),
        )
    )
