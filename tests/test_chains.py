"""Page chains by links, against following them one by one."""

import random

import pytest
from pyspark.sql import functions as F

from chartloom.operators import chains as C

SCHEMA = "url string, next_url string, n_entries long"


def followed(pages):
    """Place of each page by walking from every page that nobody names, as a fetch would."""
    after = {}
    for url, next_url, _ in pages:
        if url is not None:
            after[url] = min((x for x in (after.get(url), next_url) if x is not None), default=None)
    before = {}
    for url, next_url in after.items():
        if next_url in after:
            before[next_url] = min(before.get(next_url, url), url)
    found, ends = {}, {}
    for head in after:
        if head in before:
            continue
        at, place = head, 0
        while True:
            found[at] = (head, place)
            to = after[at]
            if to in after and before[to] == at:
                at, place = to, place + 1
                continue
            ends[head] = (place + 1, "end" if to is None else "joins" if to in after else "missing", at)
            break
    return {u: found.get(u, (None, None)) for u in after}, ends


def check(spark, pages):
    df = spark.createDataFrame(pages, SCHEMA).orderBy(F.rand(3))
    places = C.ranked(df)
    want, ends = followed(pages)
    assert {r.url: (r.head, r.place) for r in places.collect()} == want
    got = {r.head: (r.n_pages, r.ending, r.last_url) for r in C.chains(places).collect()}
    loops = sum(head is None for head, _ in want.values())
    assert got == ends | ({None: (loops, "cycle", None)} if loops else {})


def chain(name, n, last=None):
    return [(f"{name}{i}", f"{name}{i + 1}" if i < n - 1 else last, 5) for i in range(n)]


@pytest.mark.parametrize("pages", [
    [],
    chain("a", 1),
    chain("a", 2) + chain("b", 77),
    chain("a", 40, "gone"),
    chain("a", 9, "a0") + chain("b", 5),
    chain("a", 9, "a4") + chain("b", 5, "b4"),
    chain("a", 6, "b3") + chain("b", 8) + chain("c", 3, "b3"),
    chain("a", 5) + chain("a", 5) + [("a2", None, 1), ("a3", "b0", 1), (None, "a0", 9), (None, None, 0)] + chain("b", 2),
    [("x", "x", 1)],
])
def test_shapes(spark, pages):
    check(spark, pages)


def test_random_links(spark):
    draw = random.Random(5)
    for _ in range(4):
        urls = [f"u{i}" for i in range(60)]
        check(spark, [(u, draw.choice([*urls, None, "away"]), 1) for u in urls])


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    made = []
    real = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, label, *more: made.append(label) or real(df, label, *more))
    counts = []
    for n in (16, 256):
        made.clear()
        C.ranked(spark.createDataFrame(chain("a", n), SCHEMA)).count()
        counts.append(made.count("ranks"))
    assert counts[1] - counts[0] == 4


def test_kept_as_by_a_fetch(spark):
    pages = [(u, n, 0 if u == "a12" else 3 + i % 4) for i, (u, n, _) in enumerate(chain("a", 20))]
    pages += [(u, n, 7) for u, n, _ in chain("b", 10)] + [(u, n, 1) for u, n, _ in chain("c", 3, "c0")]
    df = spark.createDataFrame(pages, SCHEMA).orderBy(F.rand(1))
    sizes = {u: n for u, _, n in pages}

    def fetch(name, total):
        out, so_far, i = [], 0, 0
        while f"{name}{i}" in sizes and sizes[f"{name}{i}"] and (total is None or so_far < total):
            so_far += sizes[f"{name}{i}"]
            out.append((f"{name}{i}", f"{name}0", i, so_far))
            i += 1
        return out

    for total in (None, 20, 1):
        got = C.chain_by_links(df, total).select("url", "head", "place", "collected").collect()
        assert sorted(map(tuple, got)) == sorted(fetch("a", total) + fetch("b", total))
    only = C.chain_by_links(df, 20, ["b0"]).select("url", "head", "place", "collected").collect()
    assert sorted(map(tuple, only)) == sorted(fetch("b", 20))
