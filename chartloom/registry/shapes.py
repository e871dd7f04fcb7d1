"""Input as it comes: one pretty-printed bundle per file, files of no bytes, CSV files of several headers
and with rows that do not fit them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.plans.staging import stage_governed
from chartloom.registry import roles
from chartloom.registry.jobs import content, union
from chartloom.registry.landing import pages
from chartloom.schemas import STAGED_OBSERVATION
from chartloom.session import work_path
from chartloom.sinks.files import write_staging
from chartloom.sources.staging_csv import read_staging_any
from chartloom.sources.variants import land_variants, read_variants, variant_entries, variant_observations

_TOLD = ["patient_reference", "loinc_code", "unit", "effective_datetime", "display_name", "result_value"]


def _page_files(spark: SparkSession, raw: DataFrame) -> str:
    """Each page as a file of its own, over many lines."""
    path = work_path(spark, "page-files")
    pretty = F.regexp_replace("payload", r'([\[{,])"', '$1\n  "')
    raw.orderBy("resource_type", "page").select(pretty).write.option("maxRecordsPerFile", 1).text(path)
    return path


def _staged(staged) -> DataFrame:
    value = F.col("result_value").cast("double")
    return union(
        [
            content("patients", "patient_fhir_id", staged.patients, [None, None, "gender", "birth_date", "postal_code", None]),
            content("observations", "obs_id", staged.observations.withColumn("result_value", value), _TOLD),
            content("rejects", "resource_id", staged.rejects, [None, "rule", "severity", "resource_type", None, None]),
        ]
    )


def job_staging_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governed staging of pretty-printed page files, of which every ninth of observations breaks off."""
    raw = pages(spark, sf_dir)
    broken = (F.col("resource_type") == "Observation") & (F.col("page") % 9 == 4)
    cut = F.when(broken, F.substring("payload", 1, 60)).otherwise(F.col("payload"))
    return _staged(stage_governed(spark, _page_files(spark, raw.withColumn("payload", cut))))


def empty_files_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients from page files, and for each region a file of no bytes."""
    path = _page_files(spark, pages(spark, sf_dir).where("resource_type = 'Patient'"))
    empty = work_path(spark, "empty-files")
    for row in roles.table(spark, sf_dir, "region").select("r_regionkey").toLocalIterator():
        spark.createDataFrame([], "v string").write.text(f"{empty}/{row.r_regionkey}")
    return _staged(stage_governed(spark, path, f"{empty}/*")).select("output", "key", "code")


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exports of readings with other columns and another order, read as one."""
    path = work_path(spark, "exports")
    raw = roles.table(spark, sf_dir, "events").selectExpr("event_type", *roles.RAW_OBSERVATION)
    exports = {
        "event_type = 'click'": STAGED_OBSERVATION,
        "event_type IN ('view', 'signup')": STAGED_OBSERVATION[::-1],
        "event_type IN ('error', 'purchase')": ["unit", "obs_id", "result_value"],
    }
    for i, (which, columns) in enumerate(exports.items()):
        write_staging(raw.where(which).select(columns), f"{path}/{i}")
    found = read_staging_any(spark, f"{path}/*", ("result_value",))
    return content("observations", "obs_id", found.rows, _TOLD)


def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three values, some with one too few or too many: the others, and the rejects with their text."""
    path = work_path(spark, "exports")
    line = F.concat_ws(
        ",", F.col("event_id").cast("string"), F.col("event_type"), F.when(F.col("value") > 5, F.col("user_id").cast("string")),
        F.when(F.col("value") > 100, F.lit("more")),
    )
    lines = roles.table(spark, sf_dir, "events").select(line.alias("obs_id,unit,patient_reference"))
    lines.write.option("header", True).option("sep", "\t").csv(path)  # one column, written as it is
    found = read_staging_any(spark, path, multi_line=False)
    rows = found.rows.select("obs_id", "unit", "patient_reference", F.lit(None).cast("string").alias("rejected"))
    none = [F.lit(None).cast("string").alias(c) for c in rows.columns[:3]]
    return rows.unionByName(found.rejects.select(*none, F.col("message").alias("rejected")))


def variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by paths into landed variants. On even pages ``effectiveDateTime`` of clicks is there, but
    null, beside an ``issued`` that is not to be taken."""
    raw = pages(spark, sf_dir)
    nulled = F.regexp_replace("payload", r'"effectiveDateTime":"[^"]*","issued"', '"effectiveDateTime":null,"issued"')
    even = F.col("page") % 2 == 0
    path = work_path(spark, "variants")
    land_variants(raw.withColumn("payload", F.when(even, nulled).otherwise(F.col("payload"))), path)
    found = variant_observations(variant_entries(read_variants(spark, path)))
    return content("observations", "obs_id", found, _TOLD)


QUERIES = {
    "variant_fields": variant_fields,
    "job_staging_pages": job_staging_pages,
    "empty_files_rejected": empty_files_rejected,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_bad_rows": csv_bad_rows,
}
_PATIENTS = f"""
SELECT 'patients' AS output, patient_fhir_id AS key, NULL AS patient, CAST(NULL AS VARCHAR) AS code, gender AS one,
       birth_date AS two, postal_code AS three, CAST(NULL AS DOUBLE) AS value FROM ({roles.PATIENT_SQL})"""
_RULE = (
    "CASE WHEN coalesce(obs_id, '') = '' THEN 'MISSING_ID'"
    " WHEN coalesce(patient_reference, '') = '' THEN 'MISSING_SUBJECT' END"
)
SQL = {
    "variant_fields": f"""
SELECT 'observations' AS output, obs_id AS key, patient_reference AS patient, loinc_code AS code, unit AS one,
       CASE WHEN event_type = 'click' AND event_id // 100 % 2 = 0 THEN NULL ELSE effective_datetime END AS two,
       display_name AS three, result_value AS value
FROM ({roles.RAW_SQL}) JOIN (SELECT event_id, event_type FROM events) USING (event_id)""",
    "job_staging_pages": f"""
WITH raw AS (SELECT *, event_id // 100 AS page, {_RULE} AS rule FROM ({roles.RAW_SQL})),
pages AS (SELECT page FROM raw UNION SELECT max(page) + 1 FROM raw UNION SELECT max(page) + 2 FROM raw)
{_PATIENTS}
UNION ALL SELECT 'observations', obs_id, patient_reference, loinc_code, unit, effective_datetime, display_name,
       result_value FROM raw WHERE rule IS NULL AND page % 9 <> 4
UNION ALL SELECT 'rejects', obs_id, NULL, rule, 'WARNING', 'Observation', NULL, NULL
FROM raw WHERE rule IS NOT NULL AND page % 9 <> 4
UNION ALL SELECT 'rejects', NULL, NULL, 'CORRUPT_FILE', 'ERROR', NULL, NULL, NULL FROM pages WHERE page % 9 = 4""",
    "empty_files_rejected": f"""
SELECT output, key, code FROM ({_PATIENTS})
UNION ALL SELECT 'rejects', NULL, 'CORRUPT_FILE' FROM region""",
    "csv_mixed_headers": f"""
SELECT 'observations' AS output, nullif(obs_id, '') AS key,
       CASE WHEN event_type NOT IN ('error', 'purchase') THEN nullif(patient_reference, '') END AS patient,
       CASE WHEN event_type NOT IN ('error', 'purchase') THEN loinc_code END AS code, unit AS one,
       CASE WHEN event_type NOT IN ('error', 'purchase') THEN effective_datetime END AS two,
       CASE WHEN event_type NOT IN ('error', 'purchase') THEN display_name END AS three, result_value AS value
FROM ({roles.RAW_SQL}) JOIN (SELECT event_id, event_type FROM events) USING (event_id)""",
    "csv_bad_rows": """
WITH line AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type, CAST(user_id AS VARCHAR) AS patient, value FROM events)
SELECT id AS obs_id, event_type AS unit, patient AS patient_reference, CAST(NULL AS VARCHAR) AS rejected
FROM line WHERE value > 5 AND value <= 100
UNION ALL SELECT NULL, NULL, NULL, id || ',' || event_type FROM line WHERE value <= 5
UNION ALL SELECT NULL, NULL, NULL, id || ',' || event_type || ',' || patient || ',more' FROM line WHERE value > 100""",
}
