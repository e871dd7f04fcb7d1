"""The given tables in clinical roles: customers are patients, events are observations.

The select lists below are plain SQL that both engines read. Event types stand for measurements;
values decide which records lack an id, a subject, a code, a value or a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PATIENT = [
    "CAST(c_custkey AS STRING) AS patient_fhir_id",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE lower(c_mktsegment) END AS gender",
    "CASE WHEN c_acctbal < 1000 THEN NULL ELSE CAST(1930 + c_nationkey AS STRING) || '-05-17' END"
    " AS birth_date",
    "CASE WHEN c_nationkey < 5 THEN NULL ELSE 'Z' || CAST(c_nationkey AS STRING) END AS postal_code",
]

_ID = (
    "CASE WHEN event_type = 'click' AND value < 1 THEN NULL"
    " WHEN event_type = 'error' AND value < 1 THEN '' ELSE CAST(event_id AS STRING) END"
)
_REFERENCE = (
    "CASE WHEN event_type = 'view' AND value < 2 THEN NULL"
    " WHEN event_type IN ('click', 'error') AND value < 2 THEN ''"
    " WHEN event_type = 'signup' AND value > 90 THEN 'Location/' || CAST(user_id AS STRING)"
    " WHEN event_type = 'signup' THEN 'urn:uuid:' || CAST(user_id AS STRING)"
    " ELSE 'Patient/' || CAST(user_id AS STRING) END"
)
_CODE = (
    "CASE event_type WHEN 'click' THEN '8480-6' WHEN 'view' THEN '39156-5'"
    " WHEN 'error' THEN 'pulse-local' WHEN 'signup' THEN '18310-5'"
    " WHEN 'purchase' THEN CASE WHEN value < 15 THEN NULL ELSE 'lower-local' END END"
)
_DISPLAY = (
    "CASE event_type WHEN 'click' THEN"
    " CASE WHEN user_id < 75 THEN 'Systolic blood pressure' ELSE 'Systolic Blood Pressure' END"
    " WHEN 'view' THEN 'Body mass index' WHEN 'error' THEN 'HEART RATE (monitor)'"
    " WHEN 'purchase' THEN CASE WHEN value < 15 THEN NULL ELSE 'Diastolic PRESSURE' END END"
)
_VALUE = "CASE WHEN event_type = 'error' AND value > 150 THEN NULL ELSE value END"
_UNIT = (
    "CASE event_type WHEN 'click' THEN 'mm[Hg]' WHEN 'view' THEN 'kg/m2'"
    " WHEN 'error' THEN CASE WHEN value > 150 THEN NULL ELSE '/min' END"
    " WHEN 'signup' THEN 'Cel' ELSE 'mmHg' END"
)
_MOMENT = "replace(CAST(ts AS STRING), ' ', 'T') || 'Z'"
_EFFECTIVE = (
    "CASE WHEN event_type = 'purchase' THEN"
    " CASE WHEN value < 20 THEN NULL ELSE substr(CAST(ts AS STRING), 1, 10) END"
    f" ELSE {_MOMENT} END"
)

_REST = [
    f"{_CODE} AS loinc_code",
    f"{_DISPLAY} AS display_name",
    f"{_VALUE} AS result_value",
    f"{_UNIT} AS unit",
    f"{_EFFECTIVE} AS effective_datetime",
]
# As parsed from bundles: ids and references may be missing.
RAW_OBSERVATION = [f"{_ID} AS obs_id", f"{_REFERENCE} AS patient_reference", *_REST]
# As loaded: complete ids, references cleaned, some to patients outside the register.
OBSERVATION = [
    "CAST(event_id AS STRING) AS obs_id",
    "CASE WHEN event_type = 'signup' AND value > 60 THEN 'gone-' || CAST(user_id AS STRING)"
    " ELSE CAST(user_id AS STRING) END AS patient_fhir_id",
    *_REST,
]
# References as they come in, with blanks around them and prefixes.
DIRTY_REFERENCE = (
    "CASE event_type WHEN 'click' THEN 'Patient/' || CAST(user_id AS STRING)"
    " WHEN 'view' THEN chr(9) || ' urn:uuid:' || CAST(user_id AS STRING) || ' ' || chr(10)"
    " WHEN 'error' THEN ' Patient/' || CAST(user_id AS STRING) || ' '"
    " WHEN 'signup' THEN 'Location/' || CAST(user_id AS STRING)"
    " ELSE CAST(user_id AS STRING) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register: all customers."""
    return table(spark, sf_dir, "customer").selectExpr(*PATIENT)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", *OBSERVATION)


PATIENT_SQL = f"SELECT {', '.join(PATIENT)} FROM customer"
OBSERVATION_SQL = f"SELECT event_id, {', '.join(OBSERVATION)} FROM events"
RAW_SQL = f"SELECT event_id, {', '.join(RAW_OBSERVATION)} FROM events"
TERM_SQL = """
SELECT loinc_code, coalesce(display_name, 'Unknown Display Name') AS display_name FROM (
  SELECT loinc_code, display_name,
         row_number() OVER (PARTITION BY loinc_code ORDER BY event_id) AS rn
  FROM obs) WHERE rn = 1 AND loinc_code IS NOT NULL"""

# Patients, observations and terms as common table expressions.
BASE = f"WITH pat AS ({PATIENT_SQL}), obs AS ({OBSERVATION_SQL}), terms AS ({TERM_SQL})"

# Fixed values, written out here a second time on purpose: codes, names, limits and flags.
_FLAG = """CASE
  WHEN (contains(reading.loinc_code, '8480-6') OR contains(lower(display_name), 'systolic'))
       AND result_value > 140 THEN 'High Blood Pressure'
  WHEN (contains(reading.loinc_code, '8480-6') OR contains(lower(display_name), 'systolic'))
       AND result_value < 90 THEN 'Low Blood Pressure'
  WHEN (contains(reading.loinc_code, '8462-4') OR contains(lower(display_name), 'diastolic'))
       AND result_value > 90 THEN 'High Blood Pressure'
  WHEN (contains(reading.loinc_code, '39156-5') OR contains(lower(display_name), 'body mass index'))
       AND result_value >= 30 THEN 'Obese'
  WHEN (contains(reading.loinc_code, '39156-5') OR contains(lower(display_name), 'body mass index'))
       AND result_value >= 25 THEN 'Overweight'
  WHEN (contains(reading.loinc_code, '8867-4') OR contains(lower(display_name), 'heart rate'))
       AND result_value > 100 THEN 'Tachycardia'
  WHEN (contains(reading.loinc_code, '8867-4') OR contains(lower(display_name), 'heart rate'))
       AND result_value < 60 THEN 'Bradycardia'
  WHEN (contains(reading.loinc_code, '8310-5') OR contains(lower(display_name), 'body temperature'))
       AND result_value > 38 THEN 'Fever'
  ELSE 'Normal / Unflagged' END"""


def timeline_sql(readings: str = "obs", names: str = "terms") -> str:
    """The timeline in SQL."""
    return f"""
SELECT pat.patient_fhir_id, gender, birth_date, obs_id, reading.loinc_code,
       coalesce(display_name, 'Unknown Test') AS test_name, result_value, unit, effective_datetime,
       {_FLAG} AS clinical_flag
FROM (SELECT * EXCLUDE (display_name) FROM {readings}) AS reading
JOIN pat USING (patient_fhir_id)
LEFT JOIN {names} AS named ON named.loinc_code = reading.loinc_code"""


TIMELINE_SQL = f"{BASE}, tl AS ({timeline_sql()})"
