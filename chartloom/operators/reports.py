"""Counts and short lists over the timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.flags import UNFLAGGED
from chartloom.operators.integrity import with_parent
from chartloom.operators.timeline import name_and_flag, newest_first

# Columns of the audit list.
AUDIT_COLUMNS = ["patient_fhir_id", "test_name", "result_value", "unit", "clinical_flag"]


def flagged(timeline: DataFrame) -> DataFrame:
    return timeline.filter(F.col("clinical_flag") != UNFLAGGED)


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows per value, missing values left out, most frequent first, then by value."""
    n = F.count("*") if weight is None else F.sum(weight)
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(n.alias("n"))
        .orderBy(F.desc("n"), column)
    )


def activity(patients: DataFrame, observations: DataFrame, terms: DataFrame) -> DataFrame:
    """Timeline rows ``n`` per patient, test and flag: all the reports need, in one scan.

    Observations are counted before they meet the patients, so a patient with most of the rows
    sends a few counts per task through the join.
    """
    counts = (
        name_and_flag(observations.select("patient_fhir_id", "loinc_code", "result_value"), terms)
        .groupBy("patient_fhir_id", "test_name", "clinical_flag")
        .agg(F.count("*").alias("n"))
    )
    return with_parent(counts, patients, "patient_fhir_id")


def kpis(activity: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: distinct patients, observations, flagged observations, distinct tests.

    ``approximate`` estimates the number of patients, without a shuffle by patient.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return activity.agg(
        distinct("patient_fhir_id").alias("total_patients"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_observations"),
        F.coalesce(F.sum(F.when(F.col("clinical_flag") != UNFLAGGED, F.col("n"))), F.lit(0)).alias(
            "flagged_observations"
        ),
        F.count_distinct("test_name").alias("tests_mapped"),
    )


def n_flagged(activity: DataFrame) -> DataFrame:
    """One row: the number of flagged observations."""
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("n_flagged")
    return flagged(activity).agg(total)


def audit_list(timeline: DataFrame, n: int = 10) -> DataFrame:
    """The newest flagged observations."""
    return newest_first(flagged(timeline)).limit(n).select(AUDIT_COLUMNS)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def is_empty(df: DataFrame) -> DataFrame:
    """One row telling whether ``df`` has none; each task stops at its first row."""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))
