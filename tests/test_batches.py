"""Batches: checked, counted once, and together the same as one load."""

import random

import pytest
from pyspark.sql import functions as F

from chartloom.operators import keyfilter
from chartloom.plans import batches as B
from chartloom.plans.load import load_tables
from chartloom.sinks.tables import Tables

PERSON = "patient_fhir_id string, gender string, n long"
READING = (
    "obs_id string, patient_reference string, loinc_code string, display_name string, result_value double, "
    "unit string, src_file string, n long"
)


def frames(spark, people, readings):
    return spark.createDataFrame(people, PERSON), spark.createDataFrame(readings, READING)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def contents(tables):
    return (
        rows(tables.read("fhir_patients"), "patient_fhir_id", "gender"),
        rows(tables.read("terminology_lookup"), "loinc_code", "display_name"),
        rows(tables.read("fhir_observations"), "obs_id", "patient_fhir_id", "loinc_code", "result_value", "unit"),
    )


def records(seed, n=300):
    """Repeats, orphans whose patient comes late or never, missing ids, codes and displays."""
    draw = random.Random(seed)
    people = [(draw.choice([f"p{draw.randrange(40)}", f" Patient/p{draw.randrange(40)} ", None]), f"g{i}", i) for i in range(60)]
    readings = [
        (
            draw.choice([f"o{draw.randrange(150)}", f"o{i}", None]),
            f"Patient/p{draw.randrange(55)}",
            draw.choice(["a", "b", f"c{i % 30}", None]),
            draw.choice(["A", None, f"D{i}"]),
            float(i),
            "u",
            f"f{i // 50}.json",
            i,
        )
        for i in range(n)
    ]
    return people, readings


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_are_one_load(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(B, "EXPECTED_KEYS", 1)
    people, readings = records(seed)
    whole = Tables(spark, str(tmp_path / "whole"))
    result = load_tables(whole, *frames(spark, people, readings), order=["n"])
    parts = B.batch_tables(spark, str(tmp_path / "parts"))
    for i, (a, b, c, d) in enumerate([(0, 20, 0, 100), (20, 20, 100, 180), (20, 60, 180, 300)]):
        given = frames(spark, people[a:b], readings[c:d])
        assert B.load_batch(parts, f"b{i}", *given, order=["n"]).state == B.PUBLISHED
        before = contents(parts)
        assert B.load_batch(parts, f"b{i}", *given, order=["n"]).state == B.REPEATED
        assert contents(parts) == before
    assert contents(parts) == contents(whole)
    waiting = parts.read("parked_observations")
    assert rows(waiting, "obs_id") == rows(result.orphans, F.col("resource_id"))
    by_id = {r[-1]: r for r in readings}
    for r in waiting.collect():
        source = by_id[int(r.result_value)]
        assert (r.src_file, r.display_name, r.unit) == (source[6], source[3], source[5])


def test_parked_rows_come_back_whole(spark, tmp_path):
    tables = B.batch_tables(spark, str(tmp_path))
    readings = [("o1", "Patient/p1", "c", "C", 1.0, "kg", "a.json", 0), ("o2", "p9", "c", "X", 2.0, "kg", "a.json", 1)]
    B.load_batch(tables, "1", *frames(spark, [], readings), order=["n"])
    assert tables.read("fhir_observations").isEmpty()
    assert rows(tables.read("parked_observations"), "obs_id", "patient_fhir_id", "src_file", "batch_id") == [
        ("o1", "p1", "a.json", "1"), ("o2", "p9", "a.json", "1")
    ]
    again = [("o1", "p1", "other", "O", 7.0, "g", "b.json", 0)]
    B.load_batch(tables, "2", *frames(spark, [("p1", "f", 0)], again), order=["n"])
    assert rows(tables.read("fhir_observations"), "obs_id", "loinc_code", "result_value", "unit") == [("o1", "c", 1.0, "kg")]
    assert rows(tables.read("parked_observations"), "obs_id") == [("o2",)]
    assert rows(tables.read("terminology_lookup"), "loinc_code", "display_name") == [("c", "C")]
    assert tables.timeline().count() == 1


def test_empty_batches(spark, tmp_path):
    tables = B.batch_tables(spark, str(tmp_path))
    for i in range(2):
        assert B.load_batch(tables, f"e{i}", *frames(spark, [], []), order=["n"]).state == B.PUBLISHED
    assert all(tables.read(t).isEmpty() for t in ("fhir_patients", "fhir_observations", "parked_observations"))
    with pytest.raises(ValueError):
        B.load_batch(tables, "x", *(df.drop("n", "src_file") for df in frames(spark, [], [])))


def test_a_killed_batch_counts_when_given_again(spark, tmp_path, monkeypatch):
    tables = B.batch_tables(spark, str(tmp_path))
    given = frames(spark, [("p1", "f", 0)], [("o1", "p1", "c", "C", 1.0, "u", "a", 0)])
    with monkeypatch.context() as patch:
        patch.setattr("chartloom.sinks.versions.Versions.publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            B.load_batch(tables, "1", *given, order=["n"])
    assert tables.read("fhir_patients").isEmpty() and tables.read("load_ledger").isEmpty()
    assert B.load_batch(tables, "1", *given, order=["n"]).state == B.PUBLISHED
    assert tables.read("fhir_observations").count() == 1


def typed(spark, people, terms, readings):
    return {
        "fhir_patients": spark.createDataFrame(people, "patient_fhir_id string"),
        "terminology_lookup": spark.createDataFrame(terms, "loinc_code string, display_name string"),
        "fhir_observations": spark.createDataFrame(readings, "obs_id string, patient_fhir_id string, loinc_code string"),
    }


def test_checked_appends(spark, tmp_path):
    tables = B.batch_tables(spark, str(tmp_path))
    good = typed(spark, [("p1",), ("p2",)], [("a", "A")], [("o1", "p1", "a"), ("o2", "p2", None), (None, "p1", "a"), (None, "p1", "a")])
    assert B.append_checked(tables, "1", good).state == B.PUBLISHED
    stored = {name: tables.read(name).count() for name in good}
    assert stored == {"fhir_patients": 2, "terminology_lookup": 1, "fhir_observations": 4}
    assert B.append_checked(tables, "1", good).state == B.REPEATED
    bad = typed(
        spark,
        [("p1",), ("p3",), ("p3",)],
        [("b", None), ("b", None)],
        [("o1", "p1", "a"), ("o3", None, "a"), ("o4", "p9", "a"), ("o5", "p9", "z"), ("o6", "p3", "b"), ("o6", "p3", "b")],
    )
    outcome = B.append_checked(tables, "2", bad)
    assert outcome.state == B.REFUSED
    assert rows(outcome.violations, "table_name", "column_name", "rule", "value", "n_rows") == sorted([
        ("fhir_patients", "patient_fhir_id", "STORED KEY", "p1", 1),
        ("fhir_patients", "patient_fhir_id", "PRIMARY KEY", "p3", 2),
        ("terminology_lookup", "loinc_code", "PRIMARY KEY", "b", 2),
        ("terminology_lookup", "display_name", "NOT NULL", None, 2),
        ("fhir_observations", "obs_id", "STORED KEY", "o1", 1),
        ("fhir_observations", "obs_id", "PRIMARY KEY", "o6", 2),
        ("fhir_observations", "patient_fhir_id", "NOT NULL", None, 1),
        ("fhir_observations", "patient_fhir_id", "FOREIGN KEY", "p9", 2),
        ("fhir_observations", "loinc_code", "FOREIGN KEY", "z", 1),
    ], key=str)
    assert {name: tables.read(name).count() for name in good} == stored
    later = {"fhir_observations": typed(spark, [], [], [("o9", "p2", "a")])["fhir_observations"]}
    assert B.append_checked(tables, "2", later).state == B.PUBLISHED
    assert rows(tables.read("load_ledger").groupBy("batch_id").agg(F.sum("n_rows").alias("n")), "batch_id", "n") == [("1", 7), ("2", 1)]


def test_key_filter(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    blocks = keyfilter.blocks_for(3000)
    assert blocks > 1
    halves = [keyfilter.build(part, "k", blocks) for part in keys.randomSplit([0.5, 0.5], 1)]
    made = keyfilter.unite(halves[0].unionByName(halves[1]))
    assert made.count() == blocks
    assert keyfilter.ask(keys, "k", made, blocks, "may").where("k IS NOT NULL AND NOT may").isEmpty()
    others = spark.range(20000).select(F.concat(F.lit("other"), "id").alias("k"))
    assert keyfilter.ask(others, "k", made, blocks, "may").where("may").count() < 400
    assert keyfilter.ask(keys, "k", made.limit(0), blocks, "may").where("may").isEmpty()
    assert keyfilter.ask(keys.where("k IS NULL"), "k", made, blocks, "may").where("may").isEmpty()
