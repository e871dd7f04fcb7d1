"""Timeline join and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.operators.conform import terminology
from chartloom.operators.timeline import newest_first, normalise
from chartloom.operators.timeline import timeline as build
from chartloom.registry import roles
from chartloom.schemas import TIMELINE_VIEW
from chartloom.session import materialize


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Patients, observations and the stored terms; stored, because their size decides the join."""
    observations = roles.observations(spark, sf_dir)
    terms = terminology(observations, ["event_id"]).filter("loinc_code IS NOT NULL")
    return roles.patients(spark, sf_dir), observations, materialize(terms, "terms")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(*parts(spark, sf_dir))


def timeline_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline(spark, sf_dir).createOrReplaceTempView(TIMELINE_VIEW)
    return spark.table(TIMELINE_VIEW).drop("clinical_flag", "result_value")


def timeline_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir)


def timeline_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_first(timeline(spark, sf_dir))


# Written forms by event type: zone Z, offsets in three forms, no zone, date only, unreadable.
_TEXT = [
    "event_id",
    """CASE event_type WHEN 'click' THEN replace(CAST(ts AS STRING), ' ', 'T') || 'Z'
         WHEN 'view' THEN replace(CAST(ts AS STRING), ' ', 'T') ||
           CASE event_id % 3 WHEN 0 THEN '+02:00' WHEN 1 THEN '+02' ELSE '-05' END
         WHEN 'error' THEN CAST(ts AS STRING)
         WHEN 'signup' THEN substr(CAST(ts AS STRING), 1, 10)
         ELSE 'about ' || substr(CAST(ts AS STRING), 1, 10) END AS effective_datetime""",
    """CASE event_type WHEN 'click' THEN substr(CAST(ts AS STRING), 1, 10)
         WHEN 'view' THEN substr(CAST(ts AS STRING), 1, 7) WHEN 'error' THEN 'unknown'
         ELSE substr(CAST(ts AS STRING), 1, 4) END AS birth_date""",
    """CASE event_type WHEN 'click' THEN 'NaN' WHEN 'view' THEN '>' || CAST(value AS STRING)
         WHEN 'error' THEN CAST(value AS STRING) || 'd'
         ELSE CAST(value AS STRING) END AS result_value""",
]


def typed_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns; the date is written out, as dates come back differently from each engine."""
    text = roles.table(spark, sf_dir, "events").selectExpr(*_TEXT)
    typed = normalise(text)
    return typed.withColumn("birth_date", typed["birth_date"].cast("string"))


QUERIES = {
    "timeline_flags": timeline_flags,
    "timeline_join": timeline_join,
    "timeline_latest": timeline_latest,
    "typed_normalise": typed_normalise,
}
SQL = {
    "timeline_flags": f"{roles.TIMELINE_SQL} SELECT * FROM tl",
    "timeline_join": f"""{roles.TIMELINE_SQL}
SELECT patient_fhir_id, gender, birth_date, obs_id, loinc_code, test_name, unit, effective_datetime
FROM tl""",
    "timeline_latest": f"""{roles.TIMELINE_SQL}
SELECT * FROM tl ORDER BY effective_datetime DESC NULLS LAST, obs_id""",
    "typed_normalise": """
SELECT event_id,
  CAST(CASE event_type WHEN 'click' THEN CAST(ts AS DATE)
    WHEN 'view' THEN CAST(date_trunc('month', ts) AS DATE) WHEN 'error' THEN NULL
    ELSE CAST(date_trunc('year', ts) AS DATE) END AS VARCHAR) AS birth_date,
  CASE event_type WHEN 'click' THEN ts 
    WHEN 'view' THEN CASE WHEN event_id % 3 = 2 THEN ts + INTERVAL 5 HOUR ELSE ts - INTERVAL 2 HOUR END
    WHEN 'error' THEN ts WHEN 'signup' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END
    AS effective_datetime,
  CASE WHEN event_type NOT IN ('click', 'view', 'error') THEN value END AS result_value
FROM events""",
}
