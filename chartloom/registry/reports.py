"""Counts and lists over the timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import reports as ops
from chartloom.registry import roles
from chartloom.registry.timeline import parts, timeline


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types and brands, event types: one table of counts."""

    def counts(name: str, column: str) -> DataFrame:
        found = ops.value_counts(roles.table(spark, sf_dir, name), column)
        return found.select(F.lit(column).alias("field"), F.col(column).alias("item"), "n")

    return (
        counts("events", "event_type")
        .unionByName(counts("part", "p_type"))
        .unionByName(counts("part", "p_brand"))
    )


def flag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.value_counts(ops.activity(*parts(spark, sf_dir)), "clinical_flag", "n")


def test_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.value_counts(ops.activity(*parts(spark, sf_dir)), "test_name", "n")


def kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.kpis(ops.activity(*parts(spark, sf_dir)))


def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flagged(timeline(spark, sf_dir))


def flagged_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.audit_list(timeline(spark, sf_dir))


def preview5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.table(spark, sf_dir, "events").selectExpr("event_id", *roles.RAW_OBSERVATION)
    return ops.preview(rows, ["event_id"])


def is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether any reading is flagged, and whether any value is negative."""
    flagged = ops.is_empty(ops.flagged(timeline(spark, sf_dir)))
    negative = ops.is_empty(roles.table(spark, sf_dir, "events").filter("value < 0"))
    return flagged.withColumn("checked", F.lit("flagged")).unionByName(
        negative.withColumn("checked", F.lit("negative"))
    )


QUERIES = {
    "value_counts": value_counts,
    "flag_distribution": flag_distribution,
    "test_distribution": test_distribution,
    "kpi_row": kpi_row,
    "flagged_rows": flagged_rows,
    "flagged_top10": flagged_top10,
    "preview5": preview5,
    "is_empty": is_empty,
}
SQL = {
    "value_counts": """
SELECT 'event_type' AS field, event_type AS item, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type
UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY p_brand""",
    "flag_distribution": f"""{roles.TIMELINE_SQL}
SELECT clinical_flag, count(*) AS n FROM tl GROUP BY clinical_flag""",
    "test_distribution": f"""{roles.TIMELINE_SQL}
SELECT test_name, count(*) AS n FROM tl GROUP BY test_name""",
    "kpi_row": f"""{roles.TIMELINE_SQL}
SELECT count(DISTINCT patient_fhir_id) AS total_patients, count(*) AS total_observations,
       count(*) FILTER (WHERE clinical_flag <> 'Normal / Unflagged') AS flagged_observations,
       count(DISTINCT test_name) AS tests_mapped
FROM tl""",
    "flagged_rows": f"""{roles.TIMELINE_SQL}
SELECT * FROM tl WHERE clinical_flag <> 'Normal / Unflagged'""",
    "flagged_top10": f"""{roles.TIMELINE_SQL}
SELECT patient_fhir_id, test_name, result_value, unit, clinical_flag
FROM tl WHERE clinical_flag <> 'Normal / Unflagged'
ORDER BY effective_datetime DESC NULLS LAST, obs_id LIMIT 10""",
    "preview5": f"{roles.RAW_SQL} ORDER BY event_id LIMIT 5",
    "is_empty": f"""{roles.TIMELINE_SQL}
SELECT 'flagged' AS checked,
       (SELECT count(*) FROM tl WHERE clinical_flag <> 'Normal / Unflagged') = 0 AS is_empty
UNION ALL SELECT 'negative', (SELECT count(*) FROM events WHERE value < 0) = 0""",
}
