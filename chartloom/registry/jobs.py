"""Whole jobs and stored tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import paging
from chartloom.plans import inspection, reports
from chartloom.plans.constraints import violations
from chartloom.plans.fetched import chain_report, land_chain
from chartloom.plans.load import cluster, delete_patients, load_tables
from chartloom.plans.staging import stage_bundles, stage_governed
from chartloom.registry import roles
from chartloom.registry.landing import bundles, landing
from chartloom.registry.landing import pages as raw_pages
from chartloom.registry.timeline import parts
from chartloom.schemas import (
    SEGMENTED_TABLES,
    STAGED_OBSERVATION,
    STAGED_PATIENT,
    TIMELINE_COLUMNS,
    TIMELINE_VIEW,
)
from chartloom.session import work_path
from chartloom.sinks.files import write_staging
from chartloom.sinks.tables import Tables
from chartloom.sources.staging_csv import read_staging


BUDGET, SEGMENTS = 750, 40


def _tables(spark: SparkSession) -> Tables:
    return Tables(spark, work_path(spark, "tables"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


_SHAPES = {
    "fhir_patients": ("patient_fhir_id", [None, None, "gender", "birth_date", "postal_code", None]),
    "terminology_lookup": ("loinc_code", [None, None, "display_name", None, None, None]),
    "fhir_observations": (
        "obs_id",
        ["patient_fhir_id", "loinc_code", "unit", "effective_datetime", None, "result_value"],
    ),
}
_CONTENT = {"patient": "string", "code": "string", "one": "string", "two": "string", "three": "string", "value": "double"}


def content(output: str, key: str, df: DataFrame, columns: list[str | None]) -> DataFrame:
    """Whole rows of any table in one shape, so that several tables make one result."""
    named = [
        (F.lit(None) if c is None else F.col(c)).cast(kind).alias(name)
        for c, (name, kind) in zip(columns, _CONTENT.items(), strict=True)
    ]
    return df.select(F.lit(output).alias("output"), F.col(key).alias("key"), *named)


def contents(tables: Tables) -> DataFrame:
    return union([content(name, key, tables.read(name), columns) for name, (key, columns) in _SHAPES.items()])


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staged records with repeats: every reading comes twice, the second time with no value."""
    people = roles.table(spark, sf_dir, "customer").selectExpr("0 AS pass", "c_custkey AS place", *roles.PATIENT)
    events = roles.table(spark, sf_dir, "events")
    reference = f"{roles.DIRTY_REFERENCE} AS patient_reference"
    staged = events.selectExpr("0 AS pass", "event_id AS place", *roles.OBSERVATION, reference)
    staged = staged.drop("patient_fhir_id")
    again = staged.withColumns({"pass": F.lit(1), "result_value": F.lit(None).cast("double")})
    return people, staged.unionByName(again)


def table_append_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by name: absent columns are NULL, times have a default."""
    tables = _tables(spark)
    people = roles.table(spark, sf_dir, "customer").selectExpr(*roles.PATIENT)
    tables.append("fhir_patients", people.select("patient_fhir_id", "gender"))
    tables.append("fhir_patients", people.select("postal_code", "patient_fhir_id"))
    stored = tables.read("fhir_patients")
    return stored.select(*STAGED_PATIENT, F.col("created_at").isNotNull().alias("stamped"))


def reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables after loading twice."""
    tables = _tables(spark)
    people, readings = sources(spark, sf_dir)
    for _ in range(2):
        load_tables(tables, people, readings, ["pass", "place"])
    return contents(tables)


def reload_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows a reader sees that began before the second of three loads (of half the patients, of
    all, and of one that fails half-way), and what one sees that begins after them."""
    tables = _tables(spark)
    people, readings = sources(spark, sf_dir)
    load_tables(tables, people.where("place % 2 = 0"), readings, ["pass", "place"])
    before = tables.pinned()
    load_tables(tables, people, readings, ["pass", "place"])
    broken = F.when(F.col("pass") == 0, F.raise_error(F.lit("lost half-way")))
    try:
        load_tables(tables, people, readings.withColumn("unit", broken.cast("string")), ["pass", "place"])
    except SparkRuntimeException:
        pass
    old, new = (contents(t).withColumn("seen", F.lit(name)) for t, name in ((before, "old"), (tables, "new")))
    return old.unionByName(new)


def job_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded observations and, marked, the orphans kept out."""
    tables = _tables(spark)
    result = load_tables(tables, *sources(spark, sf_dir), ["pass", "place"])
    rows = tables.read("fhir_observations").drop("created_at").withColumn("rule", F.lit("LOADED"))
    kept = ["obs_id", "rule", "patient_fhir_id", "loinc_code", "result_value"]
    orphans = result.orphans.select(
        F.col("resource_id").alias("obs_id"),
        "rule",
        F.lit(None).cast("string").alias("patient_fhir_id"),
        F.lit(None).cast("string").alias("loinc_code"),
        F.lit(None).cast("double").alias("result_value"),
    )
    return rows.select(kept).unionByName(orphans)


def job_load_reassign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that match nobody: dealt out in turn at load, seen through the timeline view."""
    tables = _tables(spark)
    people, readings = sources(spark, sf_dir)
    foreign = readings.withColumn("patient_reference", F.concat(F.lit("Group/"), "place"))
    load_tables(tables, people, foreign, ["pass", "place"], on_no_match="reassign", null_code="nan")
    tables.create_view()
    return spark.table("vw_patient_clinical_timeline").select(TIMELINE_COLUMNS)


def job_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables after the patients of one segment are deleted with their observations."""
    tables = _tables(spark)
    load_tables(tables, *sources(spark, sf_dir), ["pass", "place"])
    delete_patients(tables, tables.read("fhir_patients").filter("gender = 'building'"))
    return contents(tables)


def delete_prunes_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables, in segments by patient, after two deletions of three patients each; and whether more
    segments were written for these than there are patients."""
    tables = Tables(spark, work_path(spark, "tables"), schemas=SEGMENTED_TABLES)
    load_tables(tables, *sources(spark, sf_dir), ["pass", "place"])
    cluster(tables, SEGMENTS)
    told = []
    for last in (3, 6):
        gone = tables.read("fhir_patients").where(f"CAST(patient_fhir_id AS BIGINT) BETWEEN {last - 2} AND {last}")
        told.append(delete_patients(tables, gone))
    few = all(t["rewritten"] <= 3 for d in told for t in d.values())
    none = [F.lit(None).cast(kind).alias(name) for name, kind in _CONTENT.items() if name != "one"]
    state = spark.range(1).select(
        F.lit("segments").alias("output"), F.lit("few rewritten").alias("key"), F.lit(str(few)).alias("one"), *none
    )
    return contents(tables).unionByName(state)


def job_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governed staging, CSV export and reading back, with the rejects logged."""
    staged = stage_governed(spark, f"{landing(spark, sf_dir)}/resource_type=*", multi_line=False)
    out = work_path(spark, "export")
    staged.export(f"{out}/patients", f"{out}/observations", f"{out}/rejects")
    people = read_staging(spark, f"{out}/patients").select(STAGED_PATIENT)
    readings = read_staging(spark, f"{out}/observations", numeric=("result_value",))
    logged = spark.read.parquet(f"{out}/rejects")
    told = ["patient_reference", "loinc_code", "unit", "effective_datetime", "display_name", "result_value"]
    return union(
        [
            content("patients", "patient_fhir_id", people, _SHAPES["fhir_patients"][1]),
            content("observations", "obs_id", readings.select(STAGED_OBSERVATION), told),
            content("rejects", "resource_id", logged, [None, "rule", "severity", "resource_type", None, None]),
        ]
    )


def job_staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles to tables to timeline flags, from landing to report."""
    staged = stage_governed(spark, f"{landing(spark, sf_dir)}/resource_type=*", multi_line=False)
    tables = _tables(spark)
    load_tables(tables, staged.patients, staged.observations)
    counts = tables.timeline().groupBy("loinc_code", "clinical_flag")
    return counts.agg(F.count("*").alias("n"))


def job_timeline_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All audit and dashboard frames as (report, item, n)."""
    found = parts(spark, sf_dir)
    activity = reports.counted(*found)
    audit, board = reports.audit(*found, activity), reports.dashboard(*found, activity)

    def counts(report: str, df: DataFrame, column: str) -> DataFrame:
        return df.select(F.lit(report).alias("report"), F.col(column).alias("item"), "n")

    kpis = board["kpis"].unpivot([], board["kpis"].columns, "item", "n")
    typed = board["timeline"].agg(F.count("effective_datetime").alias("n"))
    return union(
        [
            counts("flag_breakdown", audit["flag_breakdown"], "clinical_flag"),
            counts("flag_distribution", board["flag_distribution"], "clinical_flag"),
            counts("test_distribution", board["test_distribution"], "test_name"),
            kpis.select(F.lit("kpis").alias("report"), "item", "n"),
            typed.select(F.lit("timeline").alias("report"), F.lit("timed").alias("item"), "n"),
            audit["n_flagged"].select(
                F.lit("audit").alias("report"), F.lit("flagged").alias("item"), F.col("n_flagged").alias("n")
            ),
            audit["flagged"]
            .groupBy("clinical_flag")
            .agg(F.count("*").alias("n"))
            .select(F.lit("audit_list").alias("report"), F.col("clinical_flag").alias("item"), "n"),
        ]
    )


def job_inspect_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled entries of both types, and the pages a budgeted fetch of both types keeps."""
    samples = {
        "patient": inspection.inspect_patients(bundles(spark, sf_dir, "Patient")),
        "observation": inspection.inspect_observations(bundles(spark, sf_dir, "Observation")),
    }
    sampled = union(
        [
            sample.agg(F.count("*").alias("n")).select(
                F.lit("sample").alias("report"), F.lit(kind).alias("resource_type"), "n"
            )
            for kind, sample in samples.items()
        ]
    )
    page = F.col("bundle_id")
    pages = union(
        [
            paging.page_table(bundles(spark, sf_dir, kind), F.lit(kind), page)
            for kind in ("observation", "patient")
        ]
    )
    chain = chain_report(pages, BUDGET).groupBy("resource_type").agg(F.max("collected").alias("n"))
    return sampled.unionByName(chain.withColumn("report", F.lit("collected")))


def job_land_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and range of the pages landed within the budget."""
    path = work_path(spark, "chain")
    land_chain(raw_pages(spark, sf_dir), path, BUDGET)
    landed = spark.read.parquet(path)
    return landed.groupBy("resource_type").agg(
        F.count("*").alias("n_pages"), F.min("page").alias("first"), F.max("page").alias("last")
    )


def land_all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a budget every page of a chain lands, and one of no type and number too. The two pages
    that follow the end of each chain in the landing are reported as left out."""
    raw = raw_pages(spark, sf_dir)
    lone = raw.filter("page = 1").select(
        F.lit("unnamed").alias("resource_type"), F.lit(None).cast("bigint").alias("page"), "payload"
    )
    path = work_path(spark, "all-pages")
    report = land_chain(raw.unionByName(lone), path)
    found = spark.read.parquet(path).groupBy("resource_type").agg(F.count("*").alias("n_pages"))
    return report.join(found, "resource_type")


def missing_input_keeps_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export, and after it one of a folder that does not exist: the first is still there."""
    places = [work_path(spark, name) for name in ("patients", "observations", "rejects")]
    stage_bundles(bundles(spark, sf_dir, "patient")).export(*places)
    stage_governed(spark, work_path(spark, "mistyped")).export(*places)
    return read_staging(spark, places[0]).select(*STAGED_PATIENT)


def job_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging files to tables: what the loaded timeline holds."""
    people, readings = sources(spark, sf_dir)
    paths = [work_path(spark, name) for name in ("patients", "observations")]
    write_staging(people.orderBy("place").select(*STAGED_PATIENT), paths[0])
    write_staging(readings.orderBy("pass", "place").select(*STAGED_OBSERVATION), paths[1])
    tables = _tables(spark)
    load_tables(tables, read_staging(spark, paths[0]), read_staging(spark, paths[1]))
    return tables.timeline()


def catalog_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lasting view over tables declared in a database of their own."""
    tables = _tables(spark)
    load_tables(tables, *sources(spark, sf_dir), order=["pass", "place"])
    database = f"chartloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_path(spark, database)}'")
    tables.declare(database)
    tables.create_lasting_view(database)
    return spark.table(f"{database}.{TIMELINE_VIEW}")


def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables filled without any cleaning: patients in debt missing, those with little twice."""
    tables = _tables(spark)
    customers = roles.table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    tables.append("fhir_patients", customers.selectExpr(*roles.PATIENT))
    tables.append("fhir_patients", customers.filter("c_acctbal < 500").selectExpr(*roles.PATIENT))
    observations = roles.observations(spark, sf_dir)
    seen = observations.select("loinc_code", "display_name").distinct()
    tables.append("terminology_lookup", seen.filter("loinc_code <> '39156-5'"))
    loose = "CASE WHEN result_value > 200 THEN NULL ELSE patient_fhir_id END AS patient_fhir_id"
    tables.append("fhir_observations", observations.selectExpr("obs_id", loose, "loinc_code"))
    return violations(tables)


QUERIES = {
    "table_append_defaults": table_append_defaults,
    "reload_idempotent": reload_idempotent,
    "reload_versions": reload_versions,
    "job_staging": job_staging,
    "job_staged_load": job_staged_load,
    "job_load": job_load,
    "job_load_reassign": job_load_reassign,
    "job_delete": job_delete,
    "delete_prunes_files": delete_prunes_files,
    "job_timeline_reports": job_timeline_reports,
    "job_inspect_paging": job_inspect_paging,
    "job_land_chain": job_land_chain,
    "land_all_pages": land_all_pages,
    "missing_input_keeps_export": missing_input_keeps_export,
    "job_csv_load": job_csv_load,
    "catalog_view": catalog_view,
    "constraint_audit": constraint_audit,
}

_RAW = f"raw AS ({roles.RAW_SQL})"
_RULE = (
    "CASE WHEN coalesce(obs_id, '') = '' THEN 'MISSING_ID'"
    " WHEN coalesce(patient_reference, '') = '' THEN 'MISSING_SUBJECT' END"
)
# Observations as loaded; Location references find no patient.
LOAD_SQL = f"""{roles.BASE}, loaded AS (
  SELECT o.* FROM obs o JOIN events e ON e.event_id = o.event_id
  WHERE e.event_type <> 'signup' AND o.patient_fhir_id IN (SELECT patient_fhir_id FROM pat))"""


def contents_sql(patients: str = "pat", terms: str = "terms", loaded: str = "loaded") -> str:
    return f"""
SELECT 'fhir_patients' AS output, patient_fhir_id AS key, NULL AS patient, NULL AS code, gender AS one,
       birth_date AS two, postal_code AS three, CAST(NULL AS DOUBLE) AS value FROM {patients}
UNION ALL SELECT 'terminology_lookup', loinc_code, NULL, NULL, display_name, NULL, NULL, NULL FROM {terms}
UNION ALL SELECT 'fhir_observations', obs_id, patient_fhir_id, loinc_code, unit, effective_datetime, NULL,
       result_value FROM {loaded}"""


_RUNNING = """
WITH page AS (SELECT 'observation' AS kind, event_id // 100 AS page, count(*) AS n FROM events GROUP BY 2
  UNION ALL SELECT 'patient', c_custkey // 100, count(*) FROM customer GROUP BY 2),
running AS (SELECT *, sum(n) OVER (PARTITION BY kind ORDER BY page ROWS UNBOUNDED PRECEDING) AS so_far
            FROM page)"""
SQL = {
    "table_append_defaults": f"""
WITH pat AS (SELECT {', '.join(roles.PATIENT)} FROM customer)
SELECT patient_fhir_id, gender, CAST(NULL AS VARCHAR) AS birth_date,
       CAST(NULL AS VARCHAR) AS postal_code, true AS stamped FROM pat
UNION ALL SELECT patient_fhir_id, NULL, NULL, postal_code, true FROM pat""",
    "reload_idempotent": f"{LOAD_SQL}{contents_sql()}",
    "reload_versions": f"""{LOAD_SQL}, half AS (
  SELECT * FROM pat WHERE CAST(patient_fhir_id AS BIGINT) % 2 = 0),
half_loaded AS (SELECT * FROM loaded WHERE patient_fhir_id IN (SELECT patient_fhir_id FROM half)),
half_terms AS (SELECT * FROM terms)
SELECT 'old' AS seen, * FROM ({contents_sql('half', 'half_terms', 'half_loaded')})
UNION ALL SELECT 'new', * FROM ({contents_sql()})""",
    "job_staging": f"""
WITH {_RAW}, tagged AS (SELECT *, {_RULE} AS rule FROM raw)
SELECT 'patients' AS output, CAST(c_custkey AS VARCHAR) AS key, NULL AS patient, NULL AS code,
       gender AS one, birth_date AS two, postal_code AS three, CAST(NULL AS DOUBLE) AS value
FROM (SELECT c_custkey, {', '.join(roles.PATIENT)} FROM customer)
UNION ALL SELECT 'observations', obs_id, patient_reference, loinc_code, unit, effective_datetime, display_name,
       result_value FROM tagged WHERE rule IS NULL
UNION ALL SELECT 'rejects', obs_id, NULL, rule, 'WARNING', 'Observation', NULL, NULL
FROM tagged WHERE rule IS NOT NULL""",
    "job_staged_load": f"""
WITH {_RAW}, pat AS (SELECT {', '.join(roles.PATIENT)} FROM customer),
obs AS (SELECT *, replace(replace(patient_reference, 'Patient/', ''), 'urn:uuid:', '')
               AS patient_fhir_id
        FROM raw WHERE coalesce(obs_id, '') <> '' AND coalesce(patient_reference, '') <> ''),
terms AS ({roles.TERM_SQL}), tl AS ({roles.timeline_sql()})
SELECT loinc_code, clinical_flag, count(*) AS n FROM tl GROUP BY loinc_code, clinical_flag""",
    "job_load": f"""{LOAD_SQL}
SELECT obs_id, 'LOADED' AS rule, patient_fhir_id, loinc_code, result_value FROM loaded
UNION ALL SELECT obs_id, 'ORPHAN_PATIENT', NULL, NULL, NULL FROM obs
WHERE obs_id NOT IN (SELECT obs_id FROM loaded)""",
    "job_load_reassign": f"""{roles.BASE},
p AS (SELECT patient_fhir_id, row_number() OVER (ORDER BY patient_fhir_id) - 1 AS i FROM pat),
o AS (SELECT * REPLACE (coalesce(loinc_code, 'nan') AS loinc_code),
             row_number() OVER (ORDER BY obs_id) - 1 AS j FROM obs),
dealt AS (SELECT o.* REPLACE (p.patient_fhir_id AS patient_fhir_id)
          FROM o JOIN p ON o.j % (SELECT count(*) FROM pat) = p.i),
nan_terms AS (SELECT * FROM terms UNION ALL
              SELECT 'nan', 'Unknown Display Name' WHERE EXISTS (SELECT 1 FROM obs WHERE loinc_code IS NULL))
{roles.timeline_sql("dealt", "nan_terms")}""",
    "job_delete": f"""{LOAD_SQL}, stay AS (SELECT * FROM pat WHERE coalesce(gender, '') <> 'building'),
left_over AS (SELECT * FROM loaded WHERE patient_fhir_id IN (SELECT patient_fhir_id FROM stay))
{contents_sql('stay', 'terms', 'left_over')}""",
    "delete_prunes_files": f"""{LOAD_SQL}, stay AS (SELECT * FROM pat WHERE CAST(patient_fhir_id AS BIGINT) NOT BETWEEN 1 AND 6),
left_over AS (SELECT * FROM loaded WHERE patient_fhir_id IN (SELECT patient_fhir_id FROM stay))
{contents_sql('stay', 'terms', 'left_over')}
UNION ALL SELECT 'segments', 'few rewritten', NULL, NULL, 'True', NULL, NULL, NULL""",
    "job_timeline_reports": f"""{roles.TIMELINE_SQL},
newest AS (SELECT * FROM tl WHERE clinical_flag <> 'Normal / Unflagged'
           ORDER BY effective_datetime DESC NULLS LAST, obs_id LIMIT 10)
SELECT 'flag_breakdown' AS report, clinical_flag AS item, count(*) AS n FROM tl GROUP BY clinical_flag
UNION ALL SELECT 'flag_distribution', clinical_flag, count(*) FROM tl GROUP BY clinical_flag
UNION ALL SELECT 'test_distribution', test_name, count(*) FROM tl GROUP BY test_name
UNION ALL SELECT 'kpis', 'total_patients', count(DISTINCT patient_fhir_id) FROM tl
UNION ALL SELECT 'kpis', 'total_observations', count(*) FROM tl
UNION ALL SELECT 'kpis', 'flagged_observations', count(*) FROM tl
  WHERE clinical_flag <> 'Normal / Unflagged'
UNION ALL SELECT 'kpis', 'tests_mapped', count(DISTINCT test_name) FROM tl
UNION ALL SELECT 'timeline', 'timed', count(effective_datetime) FROM tl
UNION ALL SELECT 'audit', 'flagged', count(*) FROM tl WHERE clinical_flag <> 'Normal / Unflagged'
UNION ALL SELECT 'audit_list', clinical_flag, count(*) FROM newest GROUP BY clinical_flag""",
    "constraint_audit": f"""
WITH obs AS ({roles.OBSERVATION_SQL}),
once AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal FROM customer WHERE c_acctbal > 0),
patient AS (SELECT id FROM once UNION ALL SELECT id FROM once WHERE c_acctbal < 500),
term AS (SELECT DISTINCT loinc_code, display_name FROM obs WHERE loinc_code <> '39156-5'),
reading AS (SELECT obs_id, loinc_code,
                   CASE WHEN result_value > 200 THEN NULL ELSE patient_fhir_id END AS id FROM obs)
SELECT 'fhir_patients' AS table_name, 'patient_fhir_id' AS column_name, 'PRIMARY KEY' AS rule,
       id AS value, count(*) AS n_rows FROM patient GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'terminology_lookup', 'loinc_code', 'PRIMARY KEY', loinc_code, count(*)
FROM term GROUP BY loinc_code HAVING count(*) > 1
UNION ALL SELECT 'terminology_lookup', 'display_name', 'NOT NULL', NULL, count(*)
FROM term WHERE display_name IS NULL HAVING count(*) > 0
UNION ALL SELECT 'fhir_observations', 'patient_fhir_id', 'NOT NULL', NULL, count(*)
FROM reading WHERE id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'fhir_observations', 'patient_fhir_id', 'FOREIGN KEY', id, count(*)
FROM reading WHERE id NOT IN (SELECT id FROM patient) GROUP BY id
UNION ALL SELECT 'fhir_observations', 'loinc_code', 'FOREIGN KEY', loinc_code, count(*)
FROM reading WHERE loinc_code NOT IN (SELECT loinc_code FROM term) GROUP BY loinc_code""",
    "land_all_pages": f"""{_RUNNING}
SELECT kind AS resource_type, count(*) AS landed, 2 AS left_out, count(*) AS n_pages
FROM running GROUP BY kind
UNION ALL SELECT 'unnamed', count(*), 0, count(*) FROM running WHERE page = 1
HAVING count(*) > 0""",
    "missing_input_keeps_export": f"SELECT {', '.join(roles.PATIENT)} FROM customer",
    "job_csv_load": f"{LOAD_SQL} {roles.timeline_sql('loaded')}",
    "catalog_view": f"{LOAD_SQL} {roles.timeline_sql('loaded')}",
    "job_land_chain": f"""{_RUNNING}
SELECT kind AS resource_type, count(*) AS n_pages, min(page) AS first, max(page) AS last
FROM running WHERE so_far - n < {BUDGET} GROUP BY kind""",
    "job_inspect_paging": f"""{_RUNNING}
SELECT 'sample' AS report, kind AS resource_type, CAST(sum(least(n, 3)) AS BIGINT) AS n
FROM page GROUP BY kind
UNION ALL
SELECT 'collected', kind, CAST(max(so_far) AS BIGINT) FROM running WHERE so_far - n < {BUDGET} GROUP BY kind""",
}
