"""Patient timeline: observations with their patient, test name and risk flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.flags import clinical_flag, clinical_flag_sql
from chartloom.functions.typed import finite_sql, to_date, to_number, to_utc
from chartloom.schemas import TIMELINE_COLUMNS

UNKNOWN_TEST = "Unknown Test"


def name_and_flag(observations: DataFrame, terms: DataFrame) -> DataFrame:
    """Observations with ``test_name`` and ``clinical_flag``; every observation is kept."""
    names = terms.select("loinc_code", "display_name")
    own = [c for c in observations.columns if c != "display_name"]
    flag = clinical_flag(F.col("loinc_code"), F.col("display_name"), F.col("result_value"))
    return (
        observations.select(own)
        .withColumn("result_value", to_number(F.col("result_value")))
        .join(names, "loinc_code", "left")
        .withColumns(
            {"test_name": F.coalesce("display_name", F.lit(UNKNOWN_TEST)), "clinical_flag": flag}
        )
    )


def timeline(patients: DataFrame, observations: DataFrame, terms: DataFrame) -> DataFrame:
    """Unordered; sort at the consumer with :func:`newest_first`.

    Patients and terms should be stored tables: their size then decides the join, and where they
    are too large to broadcast, partitions of a hot patient or code are split.
    """
    people = patients.select("patient_fhir_id", "gender", "birth_date")
    named = name_and_flag(observations, terms)
    return named.join(people, "patient_fhir_id").select(TIMELINE_COLUMNS)


def timeline_sql(patients: str, observations: str, terms: str) -> str:
    """The timeline over three tables as SQL text, for a view in a catalog."""
    value = finite_sql("o.result_value")
    special = {
        "test_name": f"coalesce(t.display_name, '{UNKNOWN_TEST}')",
        "clinical_flag": clinical_flag_sql("o.loinc_code", "t.display_name", f"({value})"),
        "result_value": value,
        "gender": "p.gender",
        "birth_date": "p.birth_date",
    }
    columns = ", ".join(f"{special.get(c, f'o.{c}')} AS {c}" for c in TIMELINE_COLUMNS)
    return (
        f"SELECT {columns} FROM {observations} o "
        f"JOIN {patients} p ON p.patient_fhir_id = o.patient_fhir_id "
        f"LEFT JOIN {terms} t ON t.loinc_code = o.loinc_code"
    )


def newest_first(df: DataFrame) -> DataFrame:
    """By the time text, missing last; ids break ties."""
    return df.orderBy(F.desc_nulls_last("effective_datetime"), "obs_id")


def normalise(df: DataFrame) -> DataFrame:
    """Dates, UTC times and numbers in place of text."""
    return df.withColumns(
        {
            "birth_date": to_date(F.col("birth_date")),
            "effective_datetime": to_utc(F.col("effective_datetime")),
            "result_value": to_number(F.col("result_value")),
        }
    )
