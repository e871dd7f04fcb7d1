import math
import re
from collections import Counter

import numpy as np
import prose
import pyarrow as pa
import pytest
from checker import compare, connect

from chartloom.llm import bitslices as B
from chartloom.llm import text as T
from chartloom.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items):
    bags = [(doc, Counter(terms(text))) for doc, text, *_ in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    n_docs, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for doc, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // total
            score = sum(w[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for i, (score, none, doc) in enumerate(sorted(scored)[:10], 1):
            out.append((item, i, None if none else doc, -score))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    texts = [prose.text(20 + 37 * (i % 40), i, 60 + 11 * (i % 90)) for i in range(700)]
    texts += [texts[3]] * 40 + [texts[5] + " " + texts[9]] * 3 + ["ÀB é9 日本 w1 W1 w1-w1", "", None, "...", "w3 " * 5000]
    return [((i * 7919) % 1000, t, "en", "a") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def asked(spark, corpus):
    items = [(i, " ".join(corpus[i * 11][1].split(" ")[:30])) for i in range(30)]
    items += [(30, corpus[3][1]), (31, "àb é9 W1"), (32, None), (33, "..."), (34, "nowhere at all"), (None, "w3 w4")]
    items += [(0, items[0][1]), (0, "w5 w6"), (35, " ".join(f"w{i}" for i in range(400)))]
    return items


def test_against_brute_force(spark, table, corpus, asked):
    items = spark.createDataFrame([(*x, "k") for x in asked], "item_id long, text string, score string")
    want = brute(corpus, asked)
    assert got(B.rank(table(corpus, score="1", n="'x'").repartition(5), items)) == want


def test_blocks_of_items(spark, table, corpus, asked, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_TERMS", 150)
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert got(B.rank(table(corpus), items)) == brute(corpus, asked)


def test_bounds_hold_and_leave_documents_out(corpus):
    """No score is above its bound, and most pairs of document and item are never scored."""
    index = [b for b in B._blocks(iter([pa.RecordBatch.from_pydict({
        "doc_id": pa.array([d for d, *_ in corpus], pa.int64()), "text": pa.array([t for _, t, *_ in corpus])})]))]
    assert sum(b.column("n_docs")[0].as_py() for b in index) == 700 + 40 + 3 + 2
    texts = [" ".join(corpus[i * 11][1].split(" ")[:30]) for i in range(20)]
    words = T.words_of(pa.RecordBatch.from_pydict({"text": pa.array(texts)}), kind=T.TERM)
    found, _, starts = B.distinct_terms(words)
    query = B.Asked([found[starts[i] : starts[i + 1]] for i in range(len(texts))])
    df = np.zeros(len(query.terms), np.int64)
    for part in B._frequencies(query)(iter(index)):
        df[part.column("term").to_numpy()] += part.column("df").to_numpy()
    n_docs, n_terms = (sum(b.column(c)[0].as_py() for b in index) for c in ("n_docs", "n_terms"))
    scorer = B.Scorer(query, B._weights(df, n_docs), n_docs, n_terms, 10)
    for b in index:
        width, n, top, sizes = (b.column(c)[0] for c in ("width", "n", "top", "sizes"))
        n, top, sizes = (x.values.to_numpy() for x in (n, top, sizes))
        cells = np.frombuffer(b.column("slices")[0].as_buffer(), np.uint8).reshape(width.as_py(), -1)
        m = 10 + (90 * n_docs * n) // n_terms
        bound = scorer.bounds(width.as_py(), cells, top, m)
        every = np.arange(len(n))
        kept = (np.frombuffer(b.column(c)[0].as_buffer(), k) for c, k in (("terms", np.uint64), ("counts", np.int32)))
        exact = scorer.exact(every, m, sizes, *kept)
        assert (bound >= exact).all()
    for b in index:
        block = {c: b.column(c)[0] for c in b.schema.names}
        row = {c: block[c].values.to_numpy() for c in ("n", "top", "sizes")}
        row |= {c: block[c].as_buffer() for c in ("slices", "terms", "counts")}
        scorer.take(row | {"width": block["width"].as_py(), "doc_ids": block["doc_ids"].values})
    assert 200 <= scorer.scored < 0.7 * len(texts) * n_docs


def test_hostile(spark, hostile, nothing):
    items = spark.createDataFrame([(1, "repeated ROW and text"), (2, None), (None, "日本語 é"), (3, "x" * 70_000)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    want = brute(rows, [tuple(r) for r in items.collect()])
    assert want and got(B.rank(hostile, items)) == want
    assert B.rank(nothing, items).count() == 0
    assert B.rank(hostile, items.where("false")).count() == 0


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    name = "op11_bit_sliced_search"
    assert compare(QUERIES[name](spark, d), connect(d), SQL[name]) > 0
