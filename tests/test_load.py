"""Cleaning, loading, references, tables, CSV."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from records import bundle, coded, observation, patient, rows, write

from chartloom.operators import conform, integrity, reports
from chartloom.operators.timeline import newest_first
from chartloom.plans import reports as report_plans
from chartloom.plans.load import delete_patients, load_tables
from chartloom.plans.staging import stage_governed
from chartloom.schemas import QUARANTINE, TIMELINE_COLUMNS, TIMELINE_VIEW
from chartloom.sinks.files import log_rejects, write_staging
from chartloom.sinks.tables import Tables
from chartloom.sources.staging_csv import read_staging

OBSERVED = (
    "obs_id string, patient_reference string, loinc_code string, display_name string, "
    "result_value string, unit string, effective_datetime string, n int"
)


def staged(spark, observations, people=("p1", "p2", "p3")):
    patients = spark.createDataFrame([(p, i) for i, p in enumerate(people)], "patient_fhir_id string, n int")
    filled = [(*row, *[None] * (7 - len(row)), i) for i, row in enumerate(observations)]
    return patients, spark.createDataFrame(filled, OBSERVED)


def load(spark, tmp_path, observations, **options):
    tables = Tables(spark, str(tmp_path / "tables"))
    return tables, load_tables(tables, *staged(spark, observations), ["n"], **options)


def test_strict_load(spark, tmp_path):
    tables, result = load(
        spark,
        tmp_path,
        [
            (" o1 ", "Patient/p1", " c1 ", None, "5.5", "kg", "2024"),
            ("o2", "urn:uuid:p2", "c1", "Name", "abc"),
            ("o1", "Patient/p3", "c9", "Late repeat", "6"),
            ("o3", "Location/p1", "c2", "Two", "NaN"),
            ("o4", "Patient/p3", None, None, "1"),
            ("o5", None, "c3", "Three", "1"),
        ],
    )
    assert not result.reassigned
    columns = ["obs_id", "patient_fhir_id", "loinc_code", "result_value", "unit", "effective_datetime"]
    assert rows(tables.read("fhir_observations"), *columns) == [
        ("o1", "p1", "c1", 5.5, "kg", "2024"),
        ("o2", "p2", "c1", None, None, None),
        ("o4", "p3", None, 1.0, None, None),
    ]
    # The first display counts, even when it is missing; codes of orphans count too.
    assert rows(tables.read("terminology_lookup")) == [
        ("c1", "Unknown Display Name", None),
        ("c2", "Two", None),
        ("c3", "Three", None),
    ]
    assert rows(result.orphans, "resource_id", "rule") == [
        ("o3", "ORPHAN_PATIENT"),
        ("o5", "ORPHAN_PATIENT"),
    ]
    timeline = {r.obs_id: r.test_name for r in tables.timeline().collect()}
    assert timeline == {"o1": "Unknown Display Name", "o2": "Unknown Display Name", "o4": "Unknown Test"}


def test_compatible_null_code(spark, tmp_path):
    tables, _ = load(spark, tmp_path, [("o1", "Patient/p1", None, None, "1")], null_code="nan")
    assert rows(tables.read("terminology_lookup"), "loinc_code", "display_name") == [
        ("nan", "Unknown Display Name")
    ]
    assert rows(tables.timeline(), "loinc_code", "test_name") == [("nan", "Unknown Display Name")]


def test_reassign_only_when_nothing_matches(spark, tmp_path):
    foreign = [(f"o{i:02d}", "Location/x", "c", "C", "1") for i in range(10)]
    tables, result = load(spark, tmp_path / "a", foreign, on_no_match="reassign")
    assert result.reassigned and result.orphans.isEmpty()
    assert rows(tables.read("fhir_observations"), "obs_id", "patient_fhir_id") == [
        (f"o{i:02d}", f"p{i % 3 + 1}") for i in range(10)
    ]
    one_match = [*foreign, ("o99", "Patient/p2", "c", "C", "1")]
    tables, result = load(spark, tmp_path / "b", one_match, on_no_match="reassign")
    assert not result.reassigned and result.orphans.count() == 10
    assert rows(tables.read("fhir_observations"), "obs_id") == [("o99",)]
    tables, result = load(spark, tmp_path / "c", foreign)
    assert tables.read("fhir_observations").isEmpty() and result.orphans.count() == 10
    with pytest.raises(ValueError):
        load(spark, tmp_path / "d", foreign, on_no_match="guess")


def test_reassign_without_patients(spark):
    people, readings = staged(spark, [("o1", "x")], people=())
    readings = readings.select("obs_id", F.col("patient_reference").alias("patient_fhir_id"))
    assert integrity.reassign_round_robin(readings, people).isEmpty()


def test_load_twice_is_load_once(spark, tmp_path):
    given = [(f"o{i}", f"Patient/p{i % 5}", f"c{i % 2}", "C", str(i)) for i in range(20)]
    tables, _ = load(spark, tmp_path, given)
    once = rows(tables.read("fhir_observations").drop("created_at"))
    load(spark, tmp_path, given)
    assert rows(tables.read("fhir_observations").drop("created_at")) == once
    assert tables.read("fhir_patients").count() == 3
    assert tables.read("fhir_patients").filter("created_at IS NULL").isEmpty()


def test_kept_and_orphans_are_all(spark, tmp_path):
    given = [(f"o{i}", f"Patient/p{i % 7}", "c", "C", "1") for i in range(50)]
    tables, result = load(spark, tmp_path, given)
    kept, lost = tables.read("fhir_observations").count(), result.orphans.count()
    assert kept + lost == 50 and kept > 0 and lost > 0


def test_delete_takes_observations_along(spark, tmp_path):
    given = [(f"o{i}", f"Patient/p{i % 3 + 1}", "c", "C", "1") for i in range(9)]
    tables, _ = load(spark, tmp_path, given)
    delete_patients(tables, tables.read("fhir_patients").filter("patient_fhir_id = 'p2'"))
    assert rows(tables.read("fhir_patients"), "patient_fhir_id") == [("p1",), ("p3",)]
    assert tables.read("fhir_observations").count() == 6
    assert tables.read("fhir_observations").filter("patient_fhir_id = 'p2'").isEmpty()


def test_catalog_tables_and_view(spark, tmp_path):
    tables, _ = load(spark, tmp_path, [("o1", "Patient/p1", "8310-5", "Body temperature", "38.5")])
    spark.sql("CREATE DATABASE IF NOT EXISTS clinic")
    tables.declare("clinic")
    tables.declare("clinic")
    try:
        found = spark.sql("SELECT * FROM clinic.fhir_observations")
        assert found.schema["result_value"].dataType.simpleString() == "double"
        assert found.count() == 1
        tables.create_view()
        view = spark.table(TIMELINE_VIEW)
        assert view.columns == TIMELINE_COLUMNS
        assert rows(view, "obs_id", "clinical_flag") == [("o1", "Fever")]
    finally:
        spark.sql("DROP DATABASE clinic CASCADE")


def test_key_audits(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), (None, "y")], "k string, f string")
    parent = spark.createDataFrame([("x",)], "f string")
    assert rows(integrity.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert rows(integrity.missing_values(df, ["k", "f"])) == [("a", None), (None, "y")]
    assert rows(integrity.without_parent(df, parent, "f"), "k") == [("a",), ("b",), (None,)]
    assert rows(integrity.without_parent(df, parent, "f", null_is_orphan=False), "k") == [("b",), (None,)]
    assert rows(integrity.with_parent(df, parent, "f", keep_null=True), "k", "f") == [
        ("a", "x"),
        ("a", None),
    ]
    assert not integrity.no_overlap(df, parent, "f")
    assert integrity.no_overlap(df.filter("k = 'b'"), parent, "f")


def test_order_decides_between_copies(spark):
    df = spark.createDataFrame(
        [("k", 2, "late"), ("k", 1, "early"), (None, 5, "null late"), (None, 4, "null")],
        "k string, n int, v string",
    )
    assert rows(conform.keep_first(df, ["k"], ["n"]), "k", "v") == [("k", "early"), (None, "null")]


def test_csv_keeps_text(spark, tmp_path):
    values = [
        "plain",
        'with "quotes"',
        "comma, here",
        "line\nbreak",
        " blanks around ",
        "back\\slash",
        "tail\\",
        "ünïcode",
        "0012",
        None,
    ]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "k string, v string")
    path = str(tmp_path / "csv")
    write_staging(df.coalesce(1), path)
    write_staging(df.coalesce(1), path)
    back = read_staging(spark, path).orderBy("src_file", "src_offset", "src_row")
    assert [r.v for r in back.collect()] == values
    assert "N/A" in "".join(open(p).read() for p in tmp_path.glob("csv/part-*"))


@pytest.mark.parametrize(
    "rows_,multi_line",
    [("1,2,3\n", True), ("1\n", True), ('"1,2\n', True), ('1,"2\n3"\n', False), ("1,2,3\n", False)],
)
def test_damaged_csv_stops_the_job(spark, tmp_path, rows_, multi_line):
    file = tmp_path / "obs.csv"
    file.write_text("obs_id,unit\n0,kg\n" + rows_)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_staging(spark, str(file), multi_line=multi_line).select("obs_id").collect()


def test_csv_by_name_with_na_tokens(spark, tmp_path):
    file = tmp_path / "obs.csv"
    file.write_text('result_value,obs_id,unit\n5,a,N/A\nabc,b,null\n"",c,kg\nNaN,d,""\n')
    back = read_staging(spark, str(file), numeric=("result_value",))
    assert rows(back, "obs_id", "result_value", "unit") == [
        ("a", 5.0, None),
        ("b", None, None),
        ("c", None, "kg"),
        ("d", None, None),
    ]
    assert conform.pick(back, ["unit", "colour"]).columns == ["unit"]
    assert conform.reference_column(back) == "patient_fhir_id"


def test_from_bundles_to_reports(spark, tmp_path):
    """Repeats over files, display variants, orphans, flags."""
    bp = {"code": coded("8480-6", "Systolic blood pressure")}
    path = write(
        tmp_path / "in",
        a=bundle(
            patient("p1", gender="male", birthDate="1990-05"),
            patient("p2"),
            observation("o1", valueQuantity={"value": 150}, effectiveDateTime="2024-01-01", **bp),
            observation("o2", code=coded("29463-7", "Body weight"), valueQuantity={"value": 70}),
        ),
        b=bundle(
            patient("p1", gender="repeat"),
            observation("o1", valueQuantity={"value": 80}, **bp),
            observation("o3", "Patient/p2", valueQuantity={"value": 89.9}, issued="2024-02-02", **bp),
            observation("o4", "Patient/p9", **bp),
            observation("o5", code=coded("29463-7", "Body Weight"), valueQuantity={"value": "x"}),
            observation("o6", code={"text": "Blood Pressure"}, valueQuantity={"value": 150}),
        ),
    )
    found = stage_governed(spark, path)
    tables = Tables(spark, str(tmp_path / "tables"))
    result = load_tables(tables, found.patients, found.observations)
    assert rows(result.orphans, "resource_id", "file_name") == [("o4", "b.json")]
    people, readings, terms = (
        tables.read(n) for n in ("fhir_patients", "fhir_observations", "terminology_lookup")
    )
    ordered = newest_first(tables.timeline()).select("obs_id", "gender", "test_name", "clinical_flag")
    assert [tuple(r) for r in ordered.collect()] == [
        ("o3", None, "Systolic blood pressure", "Low Blood Pressure"),
        ("o1", "male", "Systolic blood pressure", "High Blood Pressure"),
        ("o2", "male", "Body weight", "Normal / Unflagged"),
        ("o5", "male", "Body weight", "Normal / Unflagged"),
        ("o6", "male", "Unknown Test", "Normal / Unflagged"),
    ]
    board = report_plans.dashboard(people, readings, terms)
    assert rows(board["kpis"]) == [(2, 5, 2, 3)]
    assert [tuple(r) for r in board["flag_distribution"].collect()] == [
        ("Normal / Unflagged", 3),
        ("High Blood Pressure", 1),
        ("Low Blood Pressure", 1),
    ]
    assert board["timeline"].schema["effective_datetime"].dataType.simpleString() == "timestamp_ntz"
    audit = report_plans.audit(people, readings, terms)
    assert [r.clinical_flag for r in audit["flagged"].collect()] == [
        "Low Blood Pressure",
        "High Blood Pressure",
    ]
    assert not audit["none_flagged"].collect()[0][0]


def test_rejects_are_logged_with_their_time(spark, tmp_path):
    path = write(tmp_path / "in", a=bundle(patient(""), observation("o1", reference="")))
    found = stage_governed(spark, path)
    for _ in range(2):
        log_rejects(found.rejects, str(tmp_path / "log"))
    logged = spark.read.parquet(str(tmp_path / "log"))
    assert logged.columns == QUARANTINE.fieldNames()
    assert logged.count() == 4 and logged.filter("logged_at IS NULL").isEmpty()
    assert rows(logged.filter("resource_type = 'Observation'"), "resource_id", "file_name") == [
        ("o1", "a.json")
    ] * 2


def test_load_from_csv(spark, tmp_path):
    """Staging files of another writer: any column order, order of rows decides."""
    (tmp_path / "p.csv").write_text("gender,patient_fhir_id\nN/A,Patient/p1\nmale,p1\nfemale,p2\n")
    (tmp_path / "o.csv").write_text(
        "obs_id,patient_reference,loinc_code,display_name,result_value\n"
        'a,Patient/p1,8867-4,"Heart rate, resting",59.9\na,Patient/p2,8867-4,x,100\nb,p2,N/A,N/A,150\n'
    )
    tables = Tables(spark, str(tmp_path / "tables"))
    people = read_staging(spark, str(tmp_path / "p.csv"))
    load_tables(tables, people, read_staging(spark, str(tmp_path / "o.csv")))
    assert rows(tables.read("fhir_patients"), "patient_fhir_id", "gender", "postal_code") == [
        ("p1", None, None),
        ("p2", "female", None),
    ]
    assert rows(tables.timeline(), "obs_id", "test_name", "clinical_flag") == [
        ("a", "Heart rate, resting", "Bradycardia"),
        ("b", "Unknown Test", "Normal / Unflagged"),
    ]


def test_order_must_be_known(spark, tmp_path):
    people, readings = staged(spark, [("o1", "Patient/p1")])
    with pytest.raises(ValueError):
        load_tables(Tables(spark, str(tmp_path)), people, readings)


def test_reports_of_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    tables.reset()
    given = [tables.read(n) for n in ("fhir_patients", "fhir_observations", "terminology_lookup")]
    assert rows(report_plans.dashboard(*given)["kpis"]) == [(0, 0, 0, 0)]
    assert report_plans.audit(*given)["none_flagged"].collect()[0][0]
    counts = reports.activity(*given)
    assert rows(reports.kpis(counts, approximate=True)) == [(0, 0, 0, 0)]


def test_headers_in_another_order_stop_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("obs_id,patient_reference,unit\no1,p1,kg\n")
    (tmp_path / "b.csv").write_text("patient_reference,obs_id,unit\np2,o2,kg\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header"):
            read_staging(spark, str(tmp_path), multi_line=multi_line).collect()


def test_failed_load_keeps_the_old_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))

    def given(gender):
        people = spark.createDataFrame([("p1", gender, "1", None, 0)], "patient_fhir_id string, gender string, birth_date string, postal_code string, n int")
        seen = spark.createDataFrame(
            [("o1", "p1", "c", "C", 1.0, "u", "2024", 0)],
            "obs_id string, patient_reference string, loinc_code string, display_name string, result_value double, unit string, effective_datetime string, n int",
        )
        return people, seen

    load_tables(tables, *given("old"), order=["n"])
    people, seen = given("new")
    broken = seen.withColumn("unit", F.raise_error(F.lit("lost half-way")))
    with pytest.raises(Exception, match="half-way"):
        load_tables(tables, people, broken, order=["n"])
    assert [r.gender for r in tables.read("fhir_patients").collect()] == ["old"]
    assert tables.read("fhir_observations").count() == tables.read("terminology_lookup").count() == 1
    load_tables(tables, people, seen, order=["n"])
    assert [r.gender for r in tables.read("fhir_patients").collect()] == ["new"]
    delete_patients(tables, spark.createDataFrame([("p1",)], "patient_fhir_id string"))
    assert tables.read("fhir_patients").count() == tables.read("fhir_observations").count() == 0
