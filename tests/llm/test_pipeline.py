"""The stages in order on the smallest tables, each against the operator's own definition."""

import hashlib
from collections import Counter

import checker
import corpus_pipeline
import prose
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from chartloom.llm import mixing, pieces, quality, superkmer
from chartloom.session import materialize

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, TABLES), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(steps):
    for step in steps[1:-1]:
        assert step.dtypes == steps[0].dtypes


def test_each_stage(steps):
    docs, good, single, short, mixed, encoded = ({r.doc_id: r for r in s.collect()} for s in steps)
    kept = {r.doc_id for r in quality.quality(steps[0]).where("kept").collect()}
    assert set(good) == kept < set(docs)
    assert all(good[i] == docs[i] for i in good)
    texts = Counter(tuple((r.text or "").split()) for r in single.values())
    assert set(texts.values()) == {1}
    assert {tuple(r.text.split()) for r in good.values()} >= set(texts)
    removed = {r.doc_id: r for r in superkmer.report(steps[2]).collect()}
    for i, r in removed.items():
        if r.n_removed == r.n_words:
            assert i not in short
        elif r.n_removed:
            assert hashlib.sha256(short[i].text.encode()).hexdigest() == r.kept_sha256
        else:
            assert short[i] == single[i]
    copies = {r.doc_id: r.copies for r in mixing.report(steps[3]).collect()}
    assert Counter(r.doc_id for r in steps[4].collect()) == +Counter(copies)
    model = pieces.load(corpus_pipeline.PIECE_MODEL)
    assert steps[5].count() == steps[4].count()
    for i, r in encoded.items():
        assert r.ids == model.encode(mixed[i].text) and r.n_tokens == len(r.ids)


@pytest.mark.parametrize("which", ["hostile", "nothing"])
def test_hostile_and_empty_tables(spark, request, which):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns, through all stages."""
    docs = request.getfixturevalue(which)
    if which == "hostile":  # enough good rows beside them for the stages to have something to keep
        more = [(100 + i, prose.text(60 + i, i), "en", "abc"[i % 3]) for i in range(40)]
        good = spark.createDataFrame([(*r, len(r[1])) for r in more], docs.schema.names[:5])
        clashing = {c: F.lit("kept as it is") for c in docs.columns[5:]}
        docs = docs.unionByName(good.withColumns(clashing)).unionByName(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, TABLES), name)
        assert docs.columns == request.getfixturevalue(which).columns
    name, stage = corpus_pipeline.STAGES[-1]
    last = materialize(stage(spark, docs, TABLES), name)
    assert last.count() == docs.count()
    assert (last.count() > 20) == (which == "hostile")
    assert docs.where("n_words != 'kept as it is'").isEmpty() if which == "hostile" else last.count() == 0


def test_run_is_the_registered_query(spark, steps):
    got = driver.queries()["pipeline"](spark, TABLES)
    rows = [sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in s.collect()) for s in (got, steps[-1])]
    assert rows[0] == rows[1]


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in driver.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n in driver.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, name):
    con = checker.connect(TABLES)
    assert checker.compare(driver.queries()[name](spark, TABLES), con, driver.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", [f"op{n}" for n in range(1, 11)])
def test_every_row_comes_back(spark, name):
    query = next(q for n, q in driver.queries().items() if n.startswith(f"{name}_"))
    got = query(spark, TABLES)
    if name == "op1":
        assert got.selectExpr("explode(segments) s").selectExpr("s.doc_id").distinct().count() == 200
    elif name == "op9":
        turns = spark.read.parquet(f"{TABLES}/conversations.parquet")
        assert got.count() == turns.select("conv_id").distinct().count() + 1
    else:
        assert got.count() == 200
