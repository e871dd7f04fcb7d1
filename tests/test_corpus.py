"""A made-up corpus of pretty-printed pages with known results, from files to reports.

Ten pages of twelve entries. Patients: 60 entries with 51 ids, the repeats later. Observations: 60 entries with
50 ids, of 21 codes, nine readings without a code; no reference matches a patient. One reading is a fever.
"""

import pytest
from pyspark.sql import functions as F
from records import bundle, coded, observation, patient, write

from chartloom.operators.reports import value_counts
from chartloom.operators.timeline import normalise
from chartloom.plans.load import load_tables
from chartloom.plans.staging import stage_governed
from chartloom.schemas import STAGED_OBSERVATION, STAGED_PATIENT, TABLES
from chartloom.sinks.tables import Tables
from chartloom.sources.staging_csv import read_staging


def people():
    for i in range(60):
        fields = {"gender": "female" if i % 2 else "male", "birthDate": f"19{50 + i % 50}-01-02"}
        if i % 3 == 0:
            fields["address"] = [{"postalCode": f"Z{i}", "city": "X"}, {"postalCode": "second"}]
        yield patient(f"p{i % 51}", **fields)


def readings():
    for i in range(60):
        n = i % 50
        fields = {"effectiveDateTime": f"2024-03-{1 + n % 28:02d}T10:00:00Z"} if n < 29 else {}
        if n >= 9:
            fields["code"] = coded(f"c{n % 21}", f"Test {n % 21}")
        if n == 40:
            fields["code"] = coded("8310-5", "Body temperature")
        if n < 41:
            fields["valueQuantity"] = {"value": 38.9 if n == 40 else n, "unit": "u"}
        yield observation(f"o{n:02d}", f"Patient/elsewhere-{n}", **fields)


def pages(kind, resources):
    made = list(resources)
    links = lambda k: [{"relation": "self", "url": f"{kind}?{k}"}, {"relation": "next", "url": f"{kind}?{k + 1}"}][: 2 if k < 4 else 1]
    return {f"{kind}_page_{k + 1}": bundle(*made[12 * k : 12 * k + 12], links=links(k)) for k in range(5)}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write(tmp_path_factory.mktemp("corpus"), **pages("patient", people()), **pages("observation", readings()))


@pytest.fixture(scope="module")
def staged(spark, folder):
    return stage_governed(spark, folder)


def _bag(df, columns):
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in columns]
    return sorted(tuple(r) for r in df.select(filled).collect())


def test_staging(spark, staged, tmp_path):
    assert staged.patients.count() == 60 and staged.observations.count() == 60
    assert staged.rejects.isEmpty()
    staged.export(*(str(tmp_path / n) for n in ("p", "o", "r")))
    wanted = {
        "p": [(r["id"], r["gender"], r["birthDate"], r.get("address", [{}])[0].get("postalCode")) for r in people()],
        "o": [
            (
                r["id"], r["subject"]["reference"], *(r.get("code", {}).get("coding", [{}])[0].get(k) for k in ("code", "display")),
                r.get("valueQuantity", {}).get("value"), r.get("valueQuantity", {}).get("unit"), r.get("effectiveDateTime"),
            )
            for r in readings()
        ],
    }
    for df, name, columns in ((staged.patients, "p", STAGED_PATIENT), (staged.observations, "o", STAGED_OBSERVATION)):
        written = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / name))
        assert written.columns == columns
        want = sorted(tuple("N/A" if v is None else str(v) for v in row) for row in wanted[name])
        assert _bag(df, columns) == _bag(written, columns) == want


def test_load_from_staging_files(spark, staged, tmp_path):
    """The same counts, with the order of records taken from the files."""
    staged.export(*(str(tmp_path / n) for n in ("p", "o", "r")), in_order=True)
    tables = Tables(spark, str(tmp_path / "tables"))
    given = (read_staging(spark, str(tmp_path / name)) for name in ("p", "o"))
    load_tables(tables, *given, on_no_match="reassign", null_code="nan")
    assert [tables.read(name).count() for name in TABLES] == [51, 23, 50]
    timed = normalise(tables.timeline()).filter("effective_datetime IS NOT NULL")
    assert timed.count() == 29
    assert tables.timeline().filter("result_value IS NOT NULL").count() == 41


def test_strict_load(spark, staged, tmp_path):
    tables = Tables(spark, str(tmp_path))
    result = load_tables(tables, staged.patients, staged.observations)
    assert tables.read("fhir_patients").count() == 51
    assert tables.read("terminology_lookup").count() == 22
    assert tables.read("fhir_observations").isEmpty() and result.orphans.count() == 50


def test_reassigned_load(spark, staged, tmp_path):
    tables = Tables(spark, str(tmp_path))
    load_tables(tables, staged.patients, staged.observations, on_no_match="reassign", null_code="nan")
    first = {f"p{i % 51}": g for i, g in reversed([(i, "female" if i % 2 else "male") for i in range(60)])}
    assert {r.patient_fhir_id: r.gender for r in tables.read("fhir_patients").collect()} == first
    rows = tables.timeline()
    assert rows.count() == 50 and rows.select("patient_fhir_id").distinct().count() == 50
    assert [tuple(r) for r in value_counts(rows, "clinical_flag").collect()] == [("Normal / Unflagged", 49), ("Fever", 1)]
    assert rows.filter("clinical_flag = 'Fever'").collect()[0]["obs_id"] == "o40"
    assert rows.filter("test_name = 'Unknown Display Name'").count() == 9
    assert rows.select("test_name").distinct().count() == 23
