"""Versions of the stored tables: published at once, or not at all."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chartloom.plans.load import delete_patients, load_tables
from chartloom.sinks.tables import Change, Tables
from chartloom.sinks.versions import FOLDER, Conflict, Versions

PERSON = "patient_fhir_id string, gender string, n int"
READING = "obs_id string, patient_reference string, loinc_code string, display_name string, result_value double, n int"


def given(spark, mark, ids=("p1", "p2")):
    people = spark.createDataFrame([(p, mark, 0) for p in ids], PERSON)
    readings = [(f"o{i}", p, f"c-{mark}", mark, float(i), 0) for i, p in enumerate(ids)]
    return people, spark.createDataFrame(readings, READING)


def seen(tables):
    """What the three tables hold, by the mark of the load it came from."""
    return (
        {r.gender for r in tables.read("fhir_patients").collect()},
        {r.display_name for r in tables.read("terminology_lookup").collect()},
        {r.loinc_code for r in tables.read("fhir_observations").collect()},
    )


ALL_OLD, ALL_NEW = ({"old"}, {"old"}, {"c-old"}), ({"new"}, {"new"}, {"c-new"})


def killed_at(monkeypatch, owner, name, nth, after=False):
    """Let the ``nth`` call of a method be the last thing its job does."""
    real, calls = getattr(owner, name), []

    def call(*args, **kwargs):
        calls.append(name)
        if len(calls) < nth:
            return real(*args, **kwargs)
        if after:
            real(*args, **kwargs)
        raise KeyboardInterrupt

    monkeypatch.setattr(owner, name, call)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("nth", [1, 2, 3])
def test_killed_at_each_write(spark, tmp_path, monkeypatch, nth, after):
    tables = Tables(spark, str(tmp_path))
    load_tables(tables, *given(spark, "old"), order=["n"])
    with monkeypatch.context() as patch:
        killed_at(patch, Change, "write", nth, after)
        with pytest.raises(KeyboardInterrupt):
            load_tables(tables, *given(spark, "new"), order=["n"])
    assert seen(tables) == ALL_OLD
    load_tables(tables, *given(spark, "new"), order=["n"])
    assert seen(tables) == ALL_NEW


def test_killed_before_and_after_the_rename(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    load_tables(tables, *given(spark, "old"), order=["n"])
    with monkeypatch.context() as patch:
        killed_at(patch, Versions, "publish", 1)
        with pytest.raises(KeyboardInterrupt):
            load_tables(tables, *given(spark, "new"), order=["n"])
    left = tmp_path / FOLDER / "_half-written"
    left.write_text('{"number": 2, "tab')
    assert seen(tables) == ALL_OLD and tables.version().number == 1
    with monkeypatch.context() as patch:
        killed_at(patch, Versions, "publish", 1, after=True)
        with pytest.raises(KeyboardInterrupt):
            load_tables(tables, *given(spark, "new"), order=["n"])
    assert seen(tables) == ALL_NEW and tables.version().number == 2


def test_readers_keep_their_version(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    load_tables(tables, *given(spark, "old"), order=["n"])
    reader, frame = tables.pinned(), tables.read("fhir_observations")
    load_tables(tables, *given(spark, "new"), order=["n"])
    delete_patients(tables, spark.createDataFrame([("p1",)], "patient_fhir_id string"))
    assert seen(reader) == ALL_OLD and frame.count() == 2
    assert seen(Tables(spark, str(tmp_path), 2)) == ALL_NEW
    assert tables.read("fhir_observations").count() == tables.read("fhir_patients").count() == 1


def test_two_jobs_at_once(spark, tmp_path):
    """The second to publish is told, and changes nothing."""
    tables = Tables(spark, str(tmp_path))
    people, _ = given(spark, "old")
    one, two = tables.change(), tables.change()
    one.append("fhir_patients", people)
    two.replace("fhir_patients", people.limit(0))
    assert one.publish() == 1
    with pytest.raises(Conflict):
        two.publish()
    assert tables.read("fhir_patients").count() == 2
    assert [f for f in os.listdir(tmp_path / FOLDER) if f.startswith("_")] == []


def test_a_failing_block_publishes_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    with pytest.raises(ValueError), tables.change() as new:
        new.append("fhir_patients", given(spark, "old")[0])
        assert new.read("fhir_patients").count() == 2
        raise ValueError
    assert tables.read("fhir_patients").isEmpty() and tables.version().number == 0


def test_several_folders_are_one_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for mark in ("a", "b", "c"):
        tables.append("fhir_patients", given(spark, mark)[0])
    assert sorted(r.gender for r in tables.read("fhir_patients").collect()) == list("aabbcc")
    assert len(tables.parts("fhir_patients")) == 3
    before = tables.pinned()
    tables.compact("fhir_patients")
    assert len(tables.parts("fhir_patients")) == 1
    assert tables.read("fhir_patients").exceptAll(before.read("fhir_patients")).isEmpty()
    assert tables.path("fhir_patients") == tables.path("fhir_patients")


def test_vacuum_leaves_what_kept_versions_name(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for mark in ("a", "old", "new"):
        load_tables(tables, *given(spark, mark), order=["n"])
    lost = tables.change()
    lost.append("fhir_patients", given(spark, "x")[0])
    assert tables.store.vacuum(keep=2) == []  # too young: may belong to a running job
    gone = tables.store.vacuum(keep=2, older_than_s=-60)
    assert len(gone) == 4  # three folders of the first load, and the one never published
    assert seen(tables) == ALL_NEW and seen(Tables(spark, str(tmp_path), 2)) == ALL_OLD
    assert tables.store.numbers() == [2, 3]
    load_tables(tables, *given(spark, "old"), order=["n"])
    assert tables.version().number == 4 and seen(tables) == ALL_OLD


def test_version_file(spark, tmp_path):
    """One short file, whatever the number of rows: the folders of each table."""
    tables = Tables(spark, str(tmp_path))
    load_tables(tables, *given(spark, "old"), order=["n"])
    found = json.loads((tmp_path / FOLDER / f"{1:012d}.json").read_text())
    assert found["number"] == 1
    assert {name: len(parts) for name, parts in found["tables"].items()} == {
        "fhir_patients": 1, "terminology_lookup": 1, "fhir_observations": 1
    }
    for parts in found["tables"].values():
        assert all(os.path.isdir(tmp_path / p["path"]) for p in parts)


def test_catalog_follows_when_declared_again(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    spark.sql("CREATE DATABASE IF NOT EXISTS versioned")
    try:
        for mark in ("old", "new"):
            load_tables(tables, *given(spark, mark), order=["n"])
            tables.declare("versioned")
            assert [r.gender for r in spark.table("versioned.fhir_patients").collect()] == [mark] * 2
            tables.create_lasting_view("versioned")
            assert spark.table("versioned.vw_patient_clinical_timeline").where(F.col("test_name") == mark).count() == 2
    finally:
        spark.sql("DROP DATABASE versioned CASCADE")
