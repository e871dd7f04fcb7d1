"""Looking at bundles before anything is staged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import null_to_na
from chartloom.operators import nested
from chartloom.schemas import LINEAGE


def inspect_patients(bundles: DataFrame, n: int = 3) -> DataFrame:
    """Mapped fields of the first ``n`` entries per bundle, whatever their type."""
    fields = {"patient_fhir_id": "id", "gender": "gender", "birth_date": "birthDate"}
    return nested.sample_resources(bundles, n).select(
        *LINEAGE, "bundle_id", *[null_to_na(F.col(c)).alias(name) for name, c in fields.items()]
    )


def inspect_observations(bundles: DataFrame, n: int = 3) -> DataFrame:
    sample = nested.sample_resources(bundles, n).select(
        *LINEAGE, "bundle_id", *nested.observation_fields()
    )
    shown = ["obs_id", "loinc_code", "result_value", "unit"]
    return sample.select(*LINEAGE, "bundle_id", *[null_to_na(F.col(c)).alias(c) for c in shown])
