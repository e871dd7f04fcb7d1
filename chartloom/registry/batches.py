"""Loads in batches, checked appends, replayed orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.plans import maintained
from chartloom.plans.batches import append_checked as append
from chartloom.plans.batches import batch_tables, load_batch
from chartloom.plans.load import delete_patients
from chartloom.registry import roles
from chartloom.registry.jobs import LOAD_SQL, contents, contents_sql, sources, union
from chartloom.session import work_path
from chartloom.sinks.tables import Tables

ORDER = ["pass", "place"]


def _tables(spark: SparkSession) -> Tables:
    return batch_tables(spark, work_path(spark, "tables"))


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables after three batches, in the order of one load: the first readings, the others, and all
    of them again; each is given twice."""
    tables = _tables(spark)
    people, readings = sources(spark, sf_dir)
    early = F.col("event_type").isin("click", "view", "error")
    marked = roles.table(spark, sf_dir, "events").select(F.col("event_id").alias("place"), early.alias("early"))
    readings = readings.join(marked, "place")
    once = F.col("pass") == 0
    given = [
        (people.where("place % 3 = 0"), readings.where(once & F.col("early"))),
        (people, readings.where(once & ~F.col("early"))),
        (people.limit(0), readings.where(~once)),
    ]
    for number, (some, read) in enumerate(given):
        for _ in range(2):
            load_batch(tables, f"batch-{number}", some, read.drop("early"), ORDER)
    return contents(tables)


def orphans_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings first, then their patients in two parts: the tables, and what is still parked."""
    tables = _tables(spark)
    people, readings = sources(spark, sf_dir)
    load_batch(tables, "readings", people.limit(0), readings, ORDER)
    for part in range(2):
        load_batch(tables, f"patients-{part}", people.where(F.col("place") % 2 == part), readings.limit(0), ORDER)
    parked = tables.read("parked_observations").select(
        F.lit("parked_observations").alias("output"),
        F.col("obs_id").alias("key"),
        F.col("patient_fhir_id").alias("patient"),
        F.col("loinc_code").alias("code"),
        F.col("unit").alias("one"),
        F.col("effective_datetime").alias("two"),
        F.col("display_name").alias("three"),
        F.col("result_value").alias("value"),
    )
    return contents(tables).unionByName(parked)


def append_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good batch, one that breaks rules and the good one again: what became of each, the rules broken,
    and the tables."""
    tables = _tables(spark)
    observations = roles.observations(spark, sf_dir).join(
        roles.patients(spark, sf_dir).select("patient_fhir_id"), "patient_fhir_id", "left_semi"
    )
    good = {
        "fhir_patients": roles.patients(spark, sf_dir),
        "terminology_lookup": observations.where("loinc_code IS NOT NULL")
        .groupBy("loinc_code")
        .agg(F.lit("Name").alias("display_name")),
        "fhir_observations": observations.where("result_value < 100").select("obs_id", "patient_fhir_id", "loinc_code"),
    }
    moved = F.when(F.col("result_value") > 200, F.concat(F.lit("new-"), "patient_fhir_id")).otherwise(F.col("patient_fhir_id"))
    bad = {
        "fhir_observations": observations.where("result_value >= 90").select(
            "obs_id", moved.alias("patient_fhir_id"), "loinc_code"
        )
    }
    outcomes = [append(tables, name, rows) for name, rows in (("good", good), ("bad", bad), ("good", good))]
    none = F.lit(None).cast("string")
    states = spark.createDataFrame([(i, o.state) for i, o in enumerate(outcomes)], "i long, state string").select(
        F.lit("outcome").alias("output"), F.col("i").cast("string").alias("key"), F.col("state").alias("patient"), none.alias("code")
    )
    broken = outcomes[1].violations.select(
        F.lit("violation").alias("output"), F.col("value").alias("key"), F.col("rule").alias("patient"),
        F.concat("column_name", F.lit(" "), F.col("n_rows").cast("string")).alias("code"),
    )
    return union([contents(tables).select("output", "key", "patient", "code"), states, broken])


def _counted(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables with counts, after a load, a deletion and a second load."""
    tables = batch_tables(spark, work_path(spark, "tables"), counted=True)
    people, readings = sources(spark, sf_dir)
    late = F.col("place") % 4 == 3
    load_batch(tables, "first", people, readings.where(~late), ORDER)
    delete_patients(tables, tables.read("fhir_patients").where("gender = 'building'"))
    load_batch(tables, "second", people.limit(0), readings.where(late), ORDER)
    return tables


def dashboard_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's numbers from kept counts, after a load, a deletion and a second load."""
    board = maintained.dashboard(_counted(spark, sf_dir))

    def counts(report: str, column: str) -> DataFrame:
        return board[report].select(F.lit(report).alias("report"), F.col(column).alias("item"), "n")

    kpis = board["kpis"].unpivot([], board["kpis"].columns, "item", "n")
    flagged = board["n_flagged"].select(F.lit("n_flagged").alias("report"), F.lit("flagged").alias("item"), F.col("n_flagged").alias("n"))
    return union(
        [
            counts("flag_distribution", "clinical_flag"),
            counts("test_distribution", "test_name"),
            kpis.select(F.lit("kpis").alias("report"), "item", "n"),
            flagged,
        ]
    )


def distinct_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients per flag, counted from the kept counts, and whether the united sketches of all batches
    tell them within five of their standard errors."""
    tables = _counted(spark, sf_dir)
    exact = maintained.counts(tables)
    each = exact.groupBy("clinical_flag").agg(F.count_distinct("patient_fhir_id").alias("exact"))
    every = exact.agg(F.count_distinct("patient_fhir_id").alias("exact")).withColumn("clinical_flag", F.lit(None).cast("string"))
    about = maintained.patients_per_flag(tables).withColumnRenamed("clinical_flag", "flag")
    joined = each.unionByName(every).join(about, F.col("clinical_flag").eqNullSafe(F.col("flag")))
    within = F.abs(F.col("patients") - F.col("exact")) <= F.lit(5 * maintained.SKETCH_ERROR) * F.col("exact") + 1
    return joined.select("clinical_flag", F.col("exact").alias("patients"), within.alias("within"))


QUERIES = {
    "dashboard_maintained": dashboard_maintained,
    "distinct_sketched": distinct_sketched,
    "incremental_load": incremental_load,
    "orphans_replayed": orphans_replayed,
    "append_checked": append_checked,
}
# The first display of a code comes from the earliest batch that has it.
_BATCHED = f"""{LOAD_SQL}, batched AS (
  SELECT loinc_code, display_name, row_number() OVER (PARTITION BY loinc_code ORDER BY
         CASE WHEN e.event_type IN ('click', 'view', 'error') THEN 0 ELSE 1 END, event_id) AS rn
  FROM obs JOIN events e USING (event_id)),
batch_terms AS (SELECT loinc_code, coalesce(display_name, 'Unknown Display Name') AS display_name
  FROM batched WHERE rn = 1 AND loinc_code IS NOT NULL)"""
_COUNTED = f"""{LOAD_SQL}, counted AS (
  SELECT loinc_code, display_name,
         row_number() OVER (PARTITION BY loinc_code ORDER BY CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END, event_id) AS rn
  FROM obs),
count_terms AS (SELECT loinc_code, coalesce(display_name, 'Unknown Display Name') AS display_name
  FROM counted WHERE rn = 1 AND loinc_code IS NOT NULL),
stay AS (SELECT * FROM loaded WHERE patient_fhir_id IN (
  SELECT patient_fhir_id FROM pat WHERE coalesce(gender, '') <> 'building')),
tl AS ({roles.timeline_sql('stay', 'count_terms')})"""
SQL = {
    "dashboard_maintained": f"""{_COUNTED}
SELECT 'flag_distribution' AS report, clinical_flag AS item, count(*) AS n FROM tl GROUP BY clinical_flag
UNION ALL SELECT 'test_distribution', test_name, count(*) FROM tl GROUP BY test_name
UNION ALL SELECT 'kpis', 'total_patients', count(DISTINCT patient_fhir_id) FROM tl
UNION ALL SELECT 'kpis', 'total_observations', count(*) FROM tl
UNION ALL SELECT 'kpis', 'flagged_observations', count(*) FROM tl WHERE clinical_flag <> 'Normal / Unflagged'
UNION ALL SELECT 'kpis', 'tests_mapped', count(DISTINCT test_name) FROM tl
UNION ALL SELECT 'n_flagged', 'flagged', count(*) FROM tl WHERE clinical_flag <> 'Normal / Unflagged'""",
    "distinct_sketched": f"""{_COUNTED}
SELECT clinical_flag, count(DISTINCT patient_fhir_id) AS patients, true AS within FROM tl GROUP BY clinical_flag
UNION ALL SELECT NULL, count(DISTINCT patient_fhir_id), true FROM tl""",
    "incremental_load": f"{_BATCHED}{contents_sql('pat', 'batch_terms', 'loaded')}",
    "orphans_replayed": f"""{LOAD_SQL}{contents_sql()}
UNION ALL SELECT 'parked_observations', CAST(event_id AS VARCHAR),
  CASE WHEN event_type = 'signup' THEN 'Location/' ELSE '' END || CAST(user_id AS VARCHAR),
  loinc_code, unit, effective_datetime, display_name, result_value
FROM events JOIN obs USING (event_id) WHERE obs_id NOT IN (SELECT obs_id FROM loaded)""",
    "append_checked": f"""{roles.BASE}, mine AS (
  SELECT * FROM obs WHERE patient_fhir_id IN (SELECT patient_fhir_id FROM pat)),
bad AS (SELECT *, CASE WHEN result_value > 200 THEN 'new-' || patient_fhir_id ELSE patient_fhir_id END AS moved
  FROM mine WHERE result_value >= 90)
SELECT 'fhir_patients' AS output, patient_fhir_id AS key, CAST(NULL AS VARCHAR) AS patient, CAST(NULL AS VARCHAR) AS code FROM pat
UNION ALL SELECT DISTINCT 'terminology_lookup', loinc_code, NULL, NULL FROM mine WHERE loinc_code IS NOT NULL
UNION ALL SELECT 'fhir_observations', obs_id, patient_fhir_id, loinc_code FROM mine WHERE result_value < 100
UNION ALL SELECT 'outcome', '0', 'published', NULL
UNION ALL SELECT 'outcome', '1', 'refused', NULL
UNION ALL SELECT 'outcome', '2', 'repeated', NULL
UNION ALL SELECT 'violation', obs_id, 'STORED KEY', 'obs_id 1' FROM bad WHERE result_value < 100
UNION ALL SELECT 'violation', moved, 'FOREIGN KEY', 'patient_fhir_id ' || CAST(count(*) AS VARCHAR)
FROM bad WHERE result_value > 200 GROUP BY moved""",
}
