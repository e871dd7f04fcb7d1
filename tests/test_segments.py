"""Deletions that rewrite few files."""

import os

import pytest
from pyspark.sql import functions as F

from chartloom.plans.load import cluster, delete_patients, load_tables
from chartloom.schemas import SEGMENTED_TABLES
from chartloom.sinks import segments as S
from chartloom.sinks.tables import Tables


@pytest.fixture
def tables(spark, tmp_path):
    made = Tables(spark, str(tmp_path), schemas=SEGMENTED_TABLES)
    people = spark.range(200).select(F.concat(F.lit("p"), "id").alias("patient_fhir_id"), F.lit(0).alias("n"))
    readings = spark.range(3000).select(
        F.concat(F.lit("o"), "id").alias("obs_id"),
        F.concat(F.lit("p"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 190)).alias("patient_reference"),
        F.lit("c").alias("loinc_code"), F.lit("C").alias("display_name"), F.lit(1.0).alias("result_value"), F.lit(0).alias("n"),
    )
    load_tables(made, people, readings, order=["n"])
    return made


def files(tables, name):
    """Every data file of the newest version with the time it was written."""
    found = {}
    for part in tables.parts(name):
        for folder, _, names in os.walk(f"{tables.root}/{part.path}"):
            segment = os.path.basename(folder).partition("=")[2]
            if segment and int(segment) in part.without:
                continue
            found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def ids(tables, name, column="patient_fhir_id"):
    return sorted(r[0] for r in tables.read(name).select(column).collect())


def test_only_touched_segments_are_written(spark, tables):
    want = tables.read("fhir_observations").where("patient_fhir_id NOT IN ('p7', 'p11')").exceptAll
    before_rows = tables.pinned()
    cluster(tables, 20)
    assert ids(tables, "fhir_observations", "obs_id") == ids(before_rows, "fhir_observations", "obs_id")
    before = {name: files(tables, name) for name in ("fhir_patients", "fhir_observations")}
    gone = spark.createDataFrame([("p7",), ("p11",), ("p7",), ("nobody",), (None,)], "patient_fhir_id string")
    told = delete_patients(tables, gone)
    for name in before:
        assert 1 <= told[name]["rewritten"] <= 3 and told[name]["kept"] == 20 - told[name]["rewritten"]
        after = files(tables, name)
        same = {f for f in after if f in before[name]}
        assert all(after[f] == before[name][f] for f in same)
        assert len(same) >= len(before[name]) * 0.8
    assert want(tables.read("fhir_observations")).isEmpty()
    assert set(ids(before_rows, "fhir_patients")) - set(ids(tables, "fhir_patients")) == {"p7", "p11"}
    assert not {"p7", "p11"} & set(ids(tables, "fhir_observations"))


def test_deletion_after_deletion(spark, tables):
    cluster(tables, 8)
    left = set(ids(tables, "fhir_patients"))
    for victims in (["p1", "p2"], ["p3"], ["p1"], [f"p{i}" for i in range(50, 120)], []):
        delete_patients(tables, spark.createDataFrame([(v,) for v in victims], "patient_fhir_id string"))
        left -= set(victims)
        assert ids(tables, "fhir_patients") == sorted(left)
        assert set(ids(tables, "fhir_observations")) <= left
    assert tables.read("fhir_observations").count() == sum(
        (7 if i % 3 == 0 else i % 190) not in {1, 2, 3, *range(50, 120)} for i in range(3000)
    )
    tables.compact()
    assert ids(tables, "fhir_patients") == sorted(left)
    assert all(len(tables.parts(n)) == 1 for n in ("fhir_patients", "fhir_observations"))
    delete_patients(tables, spark.createDataFrame([("p4",)], "patient_fhir_id string"))
    assert ids(tables, "fhir_patients") == sorted(left - {"p4"})


def test_nobody_is_touched(spark, tables):
    cluster(tables, 20)
    before = tables.version()
    told = delete_patients(tables, spark.createDataFrame([("nobody",)], "patient_fhir_id string"))
    assert sum(t["rewritten"] for t in told.values()) <= 1
    if not any(t["rewritten"] for t in told.values()):
        assert tables.version().tables == before.tables


def test_plain_tables(spark, tables):
    told = delete_patients(tables, spark.createDataFrame([("p5",)], "patient_fhir_id string"))
    assert told["fhir_patients"] == {"rewritten": 0, "kept": 0}
    assert "p5" not in ids(tables, "fhir_patients") + ids(tables, "fhir_observations")


def test_a_hot_patient_is_written_by_several_tasks(spark, tables, conf):
    """A third of the rows have one patient; the segment's rows are cut, and in one segment all the same."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.files.maxPartitionBytes", "4KB")
    conf("spark.sql.files.openCostInBytes", "4KB")
    conf("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor", "0.01")
    tables.replace("fhir_observations", tables.read("fhir_observations").repartition(8))
    cluster(tables, 4)
    part = tables.parts("fhir_observations")[0]
    counts = [len([n for n in os.listdir(f"{tables.root}/{part.path}/_segment={i}") if n.endswith("parquet")]) for i in range(4)]
    assert max(counts) > 1


def test_segments(spark):
    assert [S.segments_for(n) for n in (0, 1, 1 << 21, (1 << 21) + 1, 1 << 60)] == [1, 1, 1, 2, S.MOST_SEGMENTS]
    got = spark.range(1000).select(S.segment_of("id", 16).alias("s")).groupBy("s").count().collect()
    assert len(got) == 16 and all(30 < r["count"] < 100 for r in got)
