"""Record rules: every Patient or Observation is valid or carries the first rule it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import is_blank

PATIENT, OBSERVATION = "Patient", "Observation"
CORRUPT, MISSING_ID, MISSING_SUBJECT = "CORRUPT_FILE", "MISSING_ID", "MISSING_SUBJECT"
ORPHAN_PATIENT = "ORPHAN_PATIENT"


def _is_corrupt() -> Column:
    return F.col("corrupt") & F.col("src_pos").isNull()


def first_failed_rule() -> Column:
    """NULL for valid records; the id is tested before the subject, so one rule at most fails."""
    observation = F.col("resourceType") == OBSERVATION
    return (
        F.when(_is_corrupt(), F.lit(CORRUPT))
        .when(is_blank(F.col("id")), F.lit(MISSING_ID))
        .when(observation & is_blank(F.col("subject.reference")), F.lit(MISSING_SUBJECT))
    )


def tag(resources: DataFrame) -> DataFrame:
    """Patients, Observations and corrupt bundles with their ``rule``; other types are ignored."""
    known = F.col("resourceType").isin(PATIENT, OBSERVATION)
    return resources.filter(known | _is_corrupt()).withColumn("rule", first_failed_rule())


def valid(tagged: DataFrame, resource_type: str) -> DataFrame:
    return tagged.filter((F.col("resourceType") == resource_type) & F.col("rule").isNull())


def _message() -> Column:
    kind, file_name = F.col("resourceType"), F.col("src_file")
    # Message formats.
    corrupt = "CORRUPT FILE: Malformed JSON structure in file %s"
    no_id = "IG VALIDATION FAILURE [%s]: Missing mandatory 'id' in file %s"
    no_subject = (
        "IG VALIDATION FAILURE [%s]: Missing mandatory 'subject.reference' "
        "for Observation ID '%s' in file %s"
    )
    return (
        F.when(F.col("rule") == CORRUPT, F.format_string(corrupt, file_name))
        .when(F.col("rule") == MISSING_ID, F.format_string(no_id, kind, file_name))
        .otherwise(F.format_string(no_subject, kind, F.col("id"), file_name))
    )


def rejects(tagged: DataFrame) -> DataFrame:
    """Quarantine rows of tagged records that fail a rule."""
    return tagged.filter(F.col("rule").isNotNull()).select(
        F.when(F.col("rule") == CORRUPT, F.lit("ERROR"))
        .otherwise(F.lit("WARNING"))
        .alias("severity"),
        "rule",
        F.col("resourceType").alias("resource_type"),
        F.col("id").alias("resource_id"),
        F.col("src_file").alias("file_name"),
        _message().alias("message"),
    )


def corrupt_files(files: DataFrame) -> DataFrame:
    """Quarantine rows of files known to be unreadable (column ``src_file``)."""
    none = F.lit(None).cast("string")
    rule = F.lit(CORRUPT).alias("rule")
    return rejects(files.select("src_file", none.alias("resourceType"), none.alias("id"), rule))


def orphan_rejects(orphans: DataFrame) -> DataFrame:
    """Quarantine rows of observations that refer to no known patient."""
    source = F.col("src_file") if "src_file" in orphans.columns else F.lit(None).cast("string")
    return orphans.select(
        F.lit("WARNING").alias("severity"),
        F.lit(ORPHAN_PATIENT).alias("rule"),
        F.lit(OBSERVATION).alias("resource_type"),
        F.col("obs_id").alias("resource_id"),
        source.alias("file_name"),
        F.format_string(
            "Observation '%s' refers to unknown patient '%s'", "obs_id", "patient_fhir_id"
        ).alias("message"),
    )
