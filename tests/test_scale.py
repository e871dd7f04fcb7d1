"""Plans and operators under skew: one key with a third of the rows, many partitions."""

import os
import re

import pytest
from pyspark.sql import functions as F

from chartloom import session
from chartloom.operators import conform, integrity, ordinal, reports
from chartloom.operators.timeline import timeline
from chartloom.plans.load import load_tables
from chartloom.session import materialize
from chartloom.sinks.tables import Tables

ROWS = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Observations of which a third belong to patient ``p0``."""
    hot = F.col("id") % 3 == 0
    df = spark.range(ROWS, numPartitions=16).select(
        F.col("id").alias("n"),
        F.col("id").cast("string").alias("obs_id"),
        F.when(hot, F.lit("p0"))
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 997).cast("string")))
        .alias("patient_fhir_id"),
        F.lit("8310-5").alias("loinc_code"),
        F.lit("Body temperature").alias("display_name"),
        (F.col("id") % 40).cast("double").alias("result_value"),
        F.lit("Cel").alias("unit"),
        F.sha2(F.col("id").cast("string"), 512).alias("effective_datetime"),
    )
    return materialize(df, "skewed")


@pytest.fixture(scope="module")
def people(spark):
    ids = spark.range(900).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("patient_fhir_id"))
    return materialize(ids.withColumns({"gender": F.lit("x"), "birth_date": F.lit("1990")}), "people")


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def small_skew(conf, no_broadcast):
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_timeline_splits_a_hot_patient_and_a_hot_code(spark, skewed, people, small_skew):
    """Even where no side may be broadcast; all rows share one code."""
    terms = materialize(conform.terminology(skewed, ["n"]), "terms")
    df = timeline(people, skewed, terms)
    assert final_plan(df).count("skew=true") >= 2
    known = skewed.join(people, "patient_fhir_id", "left_semi").count()
    assert df.count() == known and known < ROWS


@pytest.mark.parametrize("kind", ["with_parent", "without_parent", "mark_parent"])
def test_reference_checks_split_a_hot_patient(skewed, people, small_skew, kind):
    check = getattr(integrity, kind)
    extra = ["known"] if kind == "mark_parent" else []
    df = check(skewed, people, "patient_fhir_id", *extra)
    assert "skew=true" in final_plan(df)


def test_load_of_skewed_records_is_whole(spark, skewed, people, small_skew, tmp_path):
    """A third of the rows are of one patient, another third are copies of one observation."""
    copies = F.when(F.col("n") % 3 == 1, F.lit("copy")).otherwise(F.col("obs_id"))
    readings = skewed.withColumns(
        {"obs_id": copies, "patient_reference": F.concat(F.lit("Patient/"), "patient_fhir_id")}
    ).drop("patient_fhir_id")
    tables = Tables(spark, str(tmp_path))
    patients = people.withColumn("n", F.lit(0)).withColumn("postal_code", F.lit(None).cast("string"))
    result = load_tables(tables, patients, readings, ["n"])
    expected = {}
    for i in range(ROWS):
        patient = "p0" if i % 3 == 0 else f"p{i % 997}"
        expected.setdefault("copy" if i % 3 == 1 else str(i), patient)
    known = {f"p{i}" for i in range(900)}
    loaded = tables.read("fhir_observations").select("obs_id", "patient_fhir_id").collect()
    assert {tuple(r) for r in loaded} == {(o, p) for o, p in expected.items() if p in known}
    orphans = result.orphans.select("resource_id").collect()
    assert {r[0] for r in orphans} == {o for o, p in expected.items() if p not in known}
    assert len(loaded) + len(orphans) == len(expected)


def test_dedup_reduces_before_the_shuffle(spark, conf):
    """A third of the rows share one id; each task passes on one of them."""
    df = spark.range(30_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    first = conform.keep_first(df, ["k"], ["id"])
    text = final_plan(first)
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)
    assert first.count() == 20_001
    assert first.filter("k = -1").collect()[0]["id"] == 0


def test_reports_count_before_they_join(skewed, people, no_broadcast):
    terms = materialize(conform.terminology(skewed, ["n"]), "terms")
    counts = reports.activity(people, skewed, terms)
    text = counts._jdf.queryExecution().executedPlan().toString()
    semi, aggregate = text.index("LeftSemi"), text.index("partial_count")
    assert semi < aggregate
    known = skewed.join(people, "patient_fhir_id", "left_semi").count()
    assert counts.agg(F.sum("n")).collect()[0][0] == known


def test_dense_index_over_many_partitions(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    keys = spark.range(5_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    indexed = ordinal.dense_index(keys, ["k"]).orderBy("k").collect()
    assert [r["idx"] for r in indexed] == list(range(5_000))


def test_dense_index_puts_no_rows_in_one_task(spark, no_broadcast):
    keys = spark.range(5_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    indexed = ordinal.dense_index(keys, ["k"])
    text = indexed._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("SinglePartition") :]
    assert "partial_count" in below


@pytest.mark.parametrize("bits", [0, 3, 16])
def test_running_total_over_blocks(spark, bits):
    """Groups of very different size, with gaps in the order."""
    df = spark.range(1_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("small")).otherwise(F.lit("big")).alias("g"),
        F.col("id").alias("o"),
        (F.col("id") % 7).alias("v"),
    )
    found = ordinal.running_total(df, "g", "o", "v", "total", block_bits=bits).collect()
    total = {"small": 0, "big": 0}
    expected = {}
    for i in range(1_000):
        group = "small" if i % 10 == 0 else "big"
        total[group] += i % 7
        expected[i] = total[group]
    assert {r["o"]: r["total"] for r in found} == expected


def test_reassign_deals_evenly(spark, skewed, people):
    foreign = skewed.select("obs_id", F.lit("other").alias("patient_fhir_id"))
    dealt = integrity.reassign_round_robin(foreign, people.select("patient_fhir_id"))
    sizes = [r["count"] for r in dealt.groupBy("patient_fhir_id").count().collect()]
    assert sum(sizes) == ROWS and len(sizes) == 900 and max(sizes) - min(sizes) <= 1


def test_scan_reads_only_what_is_asked(spark):
    from chartloom.registry import QUERIES

    text = QUERIES["test_distribution"](spark, "/root/testdata/sf0.001")
    plan = text._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("user_id" in s for s in scans) and not any("props" in s or "ts:" in s for s in scans)
    plan = QUERIES["cascade_delete"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(c_acctbal,0.0)" in text


@pytest.mark.parametrize(
    "size,task_mb,partitions",
    [(10**9, 256, 200), (10**12, 256, 3726), (10**14, 256, 372_530), (10**14, 1024, 93_133)],
)
def test_task_sizes(size, task_mb, partitions):
    found = session.sized(size, task_mb << 20)
    assert found["spark.sql.shuffle.partitions"] == str(partitions)
    assert found["spark.sql.files.maxPartitionBytes"] == str(task_mb << 20)


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("12345")
    (tmp_path / "y").write_text("123")
    assert session.input_bytes(spark, str(tmp_path), str(tmp_path / "none")) == 8


def test_short_lists_are_not_sorted_whole(spark):
    from chartloom.registry import QUERIES

    for name in ("flagged_top10", "preview5"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_shared_folder(spark, conf):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named.rstrip("/")
    assert session.work_path(spark, "x").startswith(named)
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_work_area_leaves_nothing_behind(spark):
    kept = materialize(spark.range(3), "kept")
    with pytest.raises(ZeroDivisionError):
        with session.work_area(spark):
            inner = session.work_path(spark, "x")
            spark.range(5).write.parquet(inner)
            assert os.path.isdir(inner)
            1 / 0
    assert not os.path.exists(os.path.dirname(inner))
    assert kept.count() == 3 and os.path.dirname(inner) != os.path.dirname(kept.inputFiles()[0])
    assert session.work_path(spark, "y").count("/kept/") == 1


class _Cluster:
    """A session on a cluster without the setting."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "yarn" if key == "spark.master" else default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Cluster())
