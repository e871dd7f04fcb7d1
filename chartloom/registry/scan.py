"""Bundle and CSV scans, nested fields, routing and record rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.typed import to_number
from chartloom.operators import governance as gov
from chartloom.operators import nested, paging
from chartloom.plans.inspection import inspect_observations
from chartloom.plans.staging import stage_governed, stage_observations, stage_patients
from chartloom.registry import roles
from chartloom.registry.landing import bundles, landing, pages
from chartloom.schemas import STAGED_OBSERVATION, STAGED_PATIENT
from chartloom.session import work_path
from chartloom.sinks.files import land_lines, land_pages, write_staging
from chartloom.sources.bundles import read_bundles, read_landed
from chartloom.sources.staging_csv import read_staging


def _number(df: DataFrame) -> DataFrame:
    return df.withColumn("result_value", to_number(F.col("result_value")))


def scan_bundle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_observations(bundles(spark, sf_dir))
    return _number(staged.select(STAGED_OBSERVATION))


def observation_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_observations(bundles(spark, sf_dir, "Observation"))
    return staged.select(STAGED_OBSERVATION)


def patient_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_patients(bundles(spark, sf_dir, "Patient")).select(STAGED_PATIENT)


def scan_corrupt_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing next to a copy in which every line lost its end."""
    whole = landing(spark, sf_dir)
    broken = work_path(spark, "broken")
    lines = spark.read.text(whole)
    cut = lines.select("resource_type", F.expr("left(value, length(value) - 1)").alias("payload"))
    land_lines(cut, broken)
    folders = (f"{whole}/resource_type=*", f"{broken}/resource_type=*")
    read = read_bundles(spark, *folders, multi_line=False)
    events = gov.rejects(gov.tag(nested.resources(read)))
    corrupt = events.filter(F.col("rule") == gov.CORRUPT)
    kinds = corrupt.groupBy("severity", "rule").agg(F.count("*").alias("n"))
    records = (
        nested.resources(read)
        .filter(F.col("resourceType").isNotNull())
        .groupBy("resourceType")
        .agg(F.count("*").alias("n"))
        .select(F.lit("READ").alias("severity"), F.col("resourceType").alias("rule"), "n")
    )
    return kinds.unionByName(records)


def scan_missing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern without files next to one with files, and on its own."""
    here = f"{landing(spark, sf_dir)}/resource_type=*"
    nothing = f"{landing(spark, sf_dir)}/resource_type=nothing/*.json"
    both = nested.entry_counts(read_bundles(spark, here, nothing, multi_line=False))
    none = nested.entry_counts(read_bundles(spark, nothing))
    total = F.coalesce(F.sum("n_entries"), F.lit(0)).alias("n_entries")
    return (
        both.agg(total)
        .withColumn("source", F.lit("both"))
        .unionByName(none.agg(total).withColumn("source", F.lit("none")))
    )


def csv_roundtrip_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "csv")
    people = roles.table(spark, sf_dir, "customer")
    write_staging(people.selectExpr(*roles.PATIENT, "c_name", "c_acctbal"), path)
    read = read_staging(spark, path, numeric=("c_acctbal",))
    return read.select(*STAGED_PATIENT, "c_name", "c_acctbal")


def csv_export_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unchecked staging export as any reader sees it: text, with ``N/A`` for what is missing."""
    path = work_path(spark, "export")
    staged = stage_observations(bundles(spark, sf_dir, "Observation"))
    write_staging(staged.select(STAGED_OBSERVATION), path)
    return spark.read.option("header", True).csv(path)


def bundle_entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.entry_counts(bundles(spark, sf_dir, "Observation")).select(
        F.col("bundle_id").alias("page"), F.col("n_entries").cast("bigint").alias("n_entries")
    )


def nested_first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_observations(bundles(spark, sf_dir, "Observation"))
    shown = staged.select("obs_id", "loinc_code", "display_name", "result_value", "unit")
    return _number(shown)


def fallback_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_observations(bundles(spark, sf_dir, "Observation"))
    return staged.select("obs_id", "effective_datetime")


def next_link_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles(spark, sf_dir, "Observation").select(
        F.col("bundle_id").alias("page"), paging.next_url(F.col("link")).alias("next_url")
    )


def bundle_sample3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect_observations(bundles(spark, sf_dir, "Observation")).select(
        F.col("bundle_id").alias("page"), "src_pos", "obs_id", "loinc_code", "unit"
    )


def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both types out of the mixed landing, with the rule each record fails."""
    tagged = gov.tag(nested.resources(bundles(spark, sf_dir)))
    rule = F.coalesce("rule", F.lit("VALID")).alias("rule")
    kinds = tagged.groupBy(F.col("resourceType").alias("resource_type"), rule)
    return kinds.agg(F.count("*").alias("n"))


def governance_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = gov.tag(nested.resources(bundles(spark, sf_dir)))
    records = gov.valid(tagged, gov.OBSERVATION).select(nested.observation_fields())
    return _number(records)


def governance_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects; the generated file name in the message is replaced by a fixed one."""
    found = gov.rejects(gov.tag(nested.resources(bundles(spark, sf_dir))))
    return found.select(
        "severity",
        "rule",
        "resource_type",
        "resource_id",
        F.replace("message", F.col("file_name"), F.lit("<file>")).alias("message"),
    )


def governance_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the three outputs of the governed job, read back from its stored routes."""
    folder = f"{landing(spark, sf_dir)}/resource_type=*"
    staged = stage_governed(spark, folder, multi_line=False)
    outputs = {
        "patients": staged.patients,
        "observations": staged.observations,
        "rejects": staged.rejects,
    }
    sizes = [
        df.agg(F.count("*").alias("n")).withColumn("output", F.lit(name))
        for name, df in outputs.items()
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


def landing_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of event types landed as payloads and counted by partition."""
    path = work_path(spark, "pages")
    events = roles.table(spark, sf_dir, "events")
    land_pages(
        events.select(
            F.upper("event_type").alias("resource_type"),
            F.col("event_id").alias("page"),
            F.col("props").alias("payload"),
        ),
        path,
    )
    landed = spark.read.parquet(path)
    return landed.groupBy("resource_type").agg(
        F.count("*").alias("n"), F.max("page").alias("last_page"), F.max("payload").alias("payload")
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads landed as a table, staged from there; records and readings per page."""
    path = work_path(spark, "landed")
    land_pages(pages(spark, sf_dir), path)
    staged = stage_observations(read_landed(spark, path, "Observation"))
    page = paging.page_from_file(F.col("src_file"))
    return staged.groupBy(page.alias("page")).agg(
        F.count("*").alias("n"), F.count("result_value").alias("n_values")
    )


QUERIES = {
    "scan_bundle_files": scan_bundle_files,
    "scan_corrupt_isolated": scan_corrupt_isolated,
    "scan_missing_input": scan_missing_input,
    "csv_roundtrip_na": csv_roundtrip_na,
    "csv_export_na": csv_export_na,
    "bundle_entry_counts": bundle_entry_counts,
    "nested_first_element": nested_first_element,
    "fallback_datetime": fallback_datetime,
    "next_link_lookup": next_link_lookup,
    "bundle_sample3": bundle_sample3,
    "patient_projection": patient_projection,
    "observation_projection": observation_projection,
    "route_by_type": route_by_type,
    "governance_valid": governance_valid,
    "governance_rejects": governance_rejects,
    "governance_single_pass": governance_single_pass,
    "landing_partitioned": landing_partitioned,
    "landed_pages": landed_pages,
}

_RAW = f"WITH raw AS ({roles.RAW_SQL}), people AS (SELECT {', '.join(roles.PATIENT)} FROM customer)"
_EXPORTED = ", ".join(
    f"nullif(coalesce(CAST({c} AS VARCHAR), 'N/A'), '') AS {c}" for c in STAGED_OBSERVATION
)
_RULE = (
    "CASE WHEN coalesce(obs_id, '') = '' THEN 'MISSING_ID'"
    " WHEN coalesce(patient_reference, '') = '' THEN 'MISSING_SUBJECT' END"
)
_TAGGED = f"{_RAW}, tagged AS (SELECT *, {_RULE} AS rule FROM raw)"
_PAGES = """
WITH page AS (SELECT event_id // 100 AS page, count(*) AS n_entries FROM events GROUP BY 1),
ends AS (SELECT max(page) AS last FROM page)"""
SQL = {
    "landed_pages": f"""{_RAW}
SELECT event_id // 100 AS page, count(*) AS n, count(result_value) AS n_values
FROM raw GROUP BY event_id // 100""",
    "scan_bundle_files": f"{_RAW} SELECT * EXCLUDE (event_id) FROM raw",
    "scan_corrupt_isolated": """
SELECT 'ERROR' AS severity, 'CORRUPT_FILE' AS rule,
       (SELECT count(DISTINCT event_id // 100) + 2 FROM events)
       + (SELECT count(DISTINCT c_custkey // 100) + 2 FROM customer) AS n
UNION ALL SELECT 'READ', 'Observation', count(*) FROM events
UNION ALL SELECT 'READ', 'Patient', count(*) FROM customer""",
    "scan_missing_input": """
SELECT 'both' AS source,
       (SELECT count(*) FROM events) + (SELECT count(*) FROM customer) AS n_entries
UNION ALL SELECT 'none', 0""",
    "csv_roundtrip_na": f"SELECT {', '.join(roles.PATIENT)}, c_name, c_acctbal FROM customer",
    "csv_export_na": f"{_RAW} SELECT {_EXPORTED} FROM raw",
    "bundle_entry_counts": f"""{_PAGES}
SELECT CAST(page AS VARCHAR) AS page, n_entries FROM page
UNION ALL SELECT CAST(last + 1 AS VARCHAR), 0 FROM ends
UNION ALL SELECT CAST(last + 2 AS VARCHAR), 0 FROM ends""",
    "nested_first_element": f"""{_RAW}
SELECT obs_id, loinc_code, display_name, result_value, unit FROM raw""",
    "fallback_datetime": f"{_RAW} SELECT obs_id, effective_datetime FROM raw",
    "next_link_lookup": f"""{_PAGES},
every AS (SELECT page FROM page UNION ALL SELECT last + 1 FROM ends UNION ALL SELECT last + 2 FROM ends)
SELECT CAST(page AS VARCHAR) AS page,
       CASE WHEN page < (SELECT last + 2 FROM ends)
            THEN 'https://records.example/Observation?page=' || CAST(page + 1 AS VARCHAR) END
       AS next_url
FROM every""",
    "bundle_sample3": f"""{_RAW},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS src_pos FROM raw)
SELECT CAST(event_id // 100 AS VARCHAR) AS page, src_pos, coalesce(obs_id, 'N/A') AS obs_id,
       coalesce(loinc_code, 'N/A') AS loinc_code, coalesce(unit, 'N/A') AS unit
FROM numbered WHERE src_pos < 3""",
    "patient_projection": f"{_RAW} SELECT * FROM people",
    "observation_projection": f"""{_RAW}
SELECT * EXCLUDE (event_id) REPLACE (CAST(result_value AS VARCHAR) AS result_value)
FROM raw""",
    "route_by_type": f"""{_TAGGED}
SELECT 'Observation' AS resource_type, coalesce(rule, 'VALID') AS rule, count(*) AS n
FROM tagged GROUP BY 2 UNION ALL SELECT 'Patient', 'VALID', count(*) FROM people""",
    "governance_valid": f"""{_TAGGED}
SELECT * EXCLUDE (event_id, rule) FROM tagged WHERE rule IS NULL""",
    "governance_rejects": f"""{_TAGGED}
SELECT 'WARNING' AS severity, rule, 'Observation' AS resource_type, obs_id AS resource_id,
       CASE rule WHEN 'MISSING_ID'
         THEN 'IG VALIDATION FAILURE [Observation]: Missing mandatory ''id'' in file <file>'
         ELSE 'IG VALIDATION FAILURE [Observation]: Missing mandatory ''subject.reference'' '
              || 'for Observation ID ''' || obs_id || ''' in file <file>' END AS message
FROM tagged WHERE rule IS NOT NULL""",
    "governance_single_pass": f"""{_TAGGED}
SELECT 'patients' AS output, count(*) AS n FROM people
UNION ALL SELECT 'observations', count(*) FROM tagged WHERE rule IS NULL
UNION ALL SELECT 'rejects', count(*) FROM tagged WHERE rule IS NOT NULL""",
    "landing_partitioned": """
SELECT event_type AS resource_type, count(*) AS n, max(event_id) AS last_page, max(props) AS payload
FROM events GROUP BY event_type""",
}
