"""Keys, references, reassignment, deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import integrity as ops
from chartloom.registry import roles
from chartloom.registry.timeline import parts


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes in use for readings above 300, as a term list that misses some codes."""
    readings = roles.observations(spark, sf_dir).filter("result_value > 360")
    return readings.select("loinc_code").filter("loinc_code IS NOT NULL").distinct()


def fk_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose patient and code both exist."""
    people, observations, terms = parts(spark, sf_dir)
    kept = ops.with_parent(observations, people, "patient_fhir_id")
    kept = ops.with_parent(kept, terms, "loinc_code")
    return kept.select("obs_id", "patient_fhir_id", "loinc_code")


def fk_semi_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose code exists or is missing."""
    observations = roles.observations(spark, sf_dir)
    kept = ops.with_parent(observations, _codes(spark, sf_dir), "loinc_code", keep_null=True)
    return kept.select("obs_id", "loinc_code")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations without patient, and, as a foreign key, without code."""
    observations = roles.observations(spark, sf_dir)
    no_patient = ops.without_parent(observations, roles.patients(spark, sf_dir), "patient_fhir_id")
    no_code = ops.without_parent(
        observations, _codes(spark, sf_dir), "loinc_code", null_is_orphan=False
    )
    return no_patient.select(F.lit("ORPHAN_PATIENT").alias("rule"), "obs_id").unionByName(
        no_code.select(F.lit("ORPHAN_CODE").alias("rule"), "obs_id")
    )


def fk_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outcomes of the patient test from one join."""
    marked = ops.mark_parent(
        roles.observations(spark, sf_dir), roles.patients(spark, sf_dir), "patient_fhir_id", "known"
    )
    return marked.select("obs_id", "known")


def key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.common_keys(
        roles.observations(spark, sf_dir), roles.patients(spark, sf_dir), "patient_fhir_id"
    )


def reassign_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References into another register match nobody, so readings are dealt out in turn."""
    people = roles.patients(spark, sf_dir)
    foreign = roles.observations(spark, sf_dir).withColumn(
        "patient_fhir_id", F.concat(F.lit("other-"), "patient_fhir_id")
    )
    readings = foreign.select("obs_id", "patient_fhir_id", "result_value")
    if ops.no_overlap(readings, people, "patient_fhir_id"):
        readings = ops.reassign_round_robin(readings, people)
    return readings


def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left after the customers in debt are deleted."""
    orders = roles.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    gone = roles.table(spark, sf_dir, "customer").filter("c_acctbal <= 0")
    left = ops.cascade_delete(orders, gone, "c_custkey")
    return left.select("o_orderkey", F.col("c_custkey").alias("o_custkey"), "o_totalprice")


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = roles.table(spark, sf_dir, "lineitem")
    return ops.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def notnull_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.table(spark, sf_dir, "events").selectExpr("event_id", *roles.RAW_OBSERVATION)
    return ops.missing_values(raw, ["obs_id", "patient_reference"]).select(
        "event_id", "obs_id", "patient_reference"
    )


QUERIES = {
    "fk_semi": fk_semi,
    "fk_semi_nullable": fk_semi_nullable,
    "fk_orphans": fk_orphans,
    "fk_marked": fk_marked,
    "key_overlap": key_overlap,
    "reassign_round_robin": reassign_round_robin,
    "cascade_delete": cascade_delete,
    "pk_violations": pk_violations,
    "notnull_violations": notnull_violations,
}
_CODES = f"""{roles.BASE}, codes AS (
  SELECT DISTINCT loinc_code FROM obs WHERE result_value > 360 AND loinc_code IS NOT NULL)"""
SQL = {
    "fk_semi": f"""{roles.BASE}
SELECT obs_id, patient_fhir_id, loinc_code FROM obs
WHERE patient_fhir_id IN (SELECT patient_fhir_id FROM pat)
  AND loinc_code IN (SELECT loinc_code FROM terms)""",
    "fk_semi_nullable": f"""{_CODES}
SELECT obs_id, loinc_code FROM obs
WHERE loinc_code IS NULL OR loinc_code IN (SELECT loinc_code FROM codes)""",
    "fk_orphans": f"""{_CODES}
SELECT 'ORPHAN_PATIENT' AS rule, obs_id FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM pat p WHERE p.patient_fhir_id = o.patient_fhir_id)
UNION ALL
SELECT 'ORPHAN_CODE', obs_id FROM obs o
WHERE loinc_code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM codes c WHERE c.loinc_code = o.loinc_code)""",
    "fk_marked": f"""{roles.BASE}
SELECT obs_id, patient_fhir_id IN (SELECT patient_fhir_id FROM pat) AS known FROM obs""",
    "key_overlap": f"""{roles.BASE}
SELECT patient_fhir_id FROM obs INTERSECT SELECT patient_fhir_id FROM pat""",
    "reassign_round_robin": f"""{roles.BASE},
p AS (SELECT patient_fhir_id, row_number() OVER (ORDER BY patient_fhir_id) - 1 AS i FROM pat),
o AS (SELECT obs_id, result_value, row_number() OVER (ORDER BY obs_id) - 1 AS j FROM obs)
SELECT obs_id, patient_fhir_id, result_value
FROM o JOIN p ON o.j % (SELECT count(*) FROM pat) = p.i""",
    "cascade_delete": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal <= 0)""",
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "notnull_violations": f"""
SELECT event_id, obs_id, patient_reference FROM ({roles.RAW_SQL})
WHERE obs_id IS NULL OR patient_reference IS NULL""",
}
