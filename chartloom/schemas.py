"""Explicit schemas of every frame that crosses a storage boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Position of a record in its source: file name, path, byte offset of the split, row in the split,
# index in the bundle. Sorting on these columns gives back file order for any number of tasks.
LINEAGE = ["src_file", "src_path", "src_offset", "src_row", "src_pos"]

# One entry, narrowed to the fields that are read. Values keep their written form, and fields that
# count only as lists are raw text until then.
ENTRY = (
    "STRUCT<resource: STRUCT<"
    "resourceType: STRING, id: STRING, gender: STRING, birthDate: STRING, "
    "address: STRING, "
    "subject: STRUCT<reference: STRING>, "
    "code: STRUCT<coding: STRING>, "
    "valueQuantity: STRUCT<value: STRING, unit: STRING>, "
    "effectiveDateTime: STRING, issued: STRING>>"
)
ADDRESSES = "ARRAY<STRUCT<postalCode: STRING>>"
CODINGS = "ARRAY<STRUCT<code: STRING, display: STRING>>"
# One bundle. Links stay raw text until they are asked for.
BUNDLE = f"STRUCT<id: STRING, entry: ARRAY<{ENTRY}>, link: STRING>"
# The same with entries as raw text, for bundles in which some entry does not fit.
LOOSE_BUNDLE = "STRUCT<id: STRING, entry: ARRAY<STRING>, link: STRING>"
LINKS = "ARRAY<STRUCT<relation: STRING, url: STRING>>"

STAGED_PATIENT = ["patient_fhir_id", "gender", "birth_date", "postal_code"]
STAGED_OBSERVATION = [
    "obs_id",
    "patient_reference",
    "loinc_code",
    "display_name",
    "result_value",
    "unit",
    "effective_datetime",
]


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Stored tables (fixed values: table and column names).
PATIENTS = _table(
    ("patient_fhir_id", T.StringType()),
    ("gender", T.StringType()),
    ("birth_date", T.StringType()),
    ("postal_code", T.StringType()),
    ("created_at", T.TimestampType()),
)
TERMS = _table(
    ("loinc_code", T.StringType()),
    ("display_name", T.StringType()),
    ("target_unit", T.StringType()),
)
OBSERVATIONS = _table(
    ("obs_id", T.StringType()),
    ("patient_fhir_id", T.StringType()),
    ("loinc_code", T.StringType()),
    ("result_value", T.DoubleType()),
    ("unit", T.StringType()),
    ("effective_datetime", T.StringType()),
    ("created_at", T.TimestampType()),
)
QUARANTINE = _table(
    ("logged_at", T.TimestampType()),
    ("severity", T.StringType()),
    ("rule", T.StringType()),
    ("resource_type", T.StringType()),
    ("resource_id", T.StringType()),
    ("file_name", T.StringType()),
    ("message", T.StringType()),
)
TABLES = {
    "fhir_patients": PATIENTS,
    "terminology_lookup": TERMS,
    "fhir_observations": OBSERVATIONS,
}
# Observations whose patient is not there yet, whole and with their source.
PARKED = T.StructType(
    [
        *(f for f in OBSERVATIONS if f.name != "created_at"),
        T.StructField("display_name", T.StringType()),
        T.StructField("src_file", T.StringType()),
        T.StructField("src_path", T.StringType()),
        T.StructField("src_row", T.LongType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
LEDGER = _table(
    ("batch_id", T.StringType()),
    ("table_name", T.StringType()),
    ("n_rows", T.LongType()),
    ("applied_at", T.TimestampType()),
)
KEY_FILTER = _table(("block", T.LongType()), ("bits", T.BinaryType()), ("blocks", T.LongType()))
SEGMENT_FILTERS = _table(
    ("path", T.StringType()),
    ("segments", T.IntegerType()),
    ("blocks", T.LongType()),
    ("segment", T.IntegerType()),
    ("block", T.LongType()),
    ("bits", T.BinaryType()),
)
SEGMENTED_TABLES = {**TABLES, "segment_filters": SEGMENT_FILTERS}
BATCH_TABLES = {
    **TABLES,
    "parked_observations": PARKED,
    "load_ledger": LEDGER,
    "observation_key_filter": KEY_FILTER,
}
ACTIVITY = _table(
    ("patient_fhir_id", T.StringType()),
    ("test_name", T.StringType()),
    ("clinical_flag", T.StringType()),
    ("n", T.LongType()),
    ("batch_id", T.StringType()),
)
SKETCHES = _table(("clinical_flag", T.StringType()), ("sketch", T.BinaryType()), ("batch_id", T.StringType()))
MAINTAINED_TABLES = {
    **SEGMENTED_TABLES,
    **BATCH_TABLES,
    "activity_deltas": ACTIVITY,
    "patient_sketches": SKETCHES,
}
# Constraints of the stored tables (fixed values): table and column; for references also the parent.
PRIMARY_KEYS = [
    ("fhir_patients", "patient_fhir_id"),
    ("terminology_lookup", "loinc_code"),
    ("fhir_observations", "obs_id"),
]
NOT_NULL = [
    ("terminology_lookup", "display_name"),
    ("fhir_observations", "patient_fhir_id"),
]
FOREIGN_KEYS = [
    ("fhir_observations", "patient_fhir_id", "fhir_patients"),
    ("fhir_observations", "loinc_code", "terminology_lookup"),
]
TIMELINE_VIEW = "vw_patient_clinical_timeline"
TIMELINE_COLUMNS = [
    "patient_fhir_id",
    "gender",
    "birth_date",
    "obs_id",
    "loinc_code",
    "test_name",
    "result_value",
    "unit",
    "effective_datetime",
    "clinical_flag",
]
