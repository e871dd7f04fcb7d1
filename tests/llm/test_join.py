from collections import defaultdict

import numpy as np
import prose
import pytest
from checker import compare, connect

from chartloom.llm import combinations as C
from chartloom.llm.queries import QUERIES, SQL

LOWER = {i: i + 32 for i in range(65, 91)}


def sets(text):
    words = prose.WORD.findall((text or "").translate(LOWER))
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def linked(a, b):
    return bool(a) and 100 * len(a & b) >= 90 * len(a | b)


def brute(rows):
    """(doc_id, n_shingles, component_id) from all pairs."""
    rows = [(doc, sets(text)) for doc, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(rows[i][1], rows[j][1]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(((doc, len(s), least[find(i)]) for i, (doc, s) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def copies():
    texts = [prose.text(20 + 9 * i, i, 100_000) for i in range(40)]
    texts += [prose.edit(t, k, 7 * i + k) for i, t in enumerate(texts) for k in (1, 2, 4)]
    texts += [" ".join(t.split(" ")[j:]) for t in texts[:40] for j in (2, 5, 12)]
    texts += [texts[0].upper(), "  ".join(texts[1].split(" ")), "one", "One", "two words", "two  words", None, "", " \n"]
    texts += [" ".join([texts[4]] * 3), "w1 w2 w3 w4", "w1 w2 w3 w4 w5"]
    return [((i * 7919) % 1000, t, "en", "a") for i, t in enumerate(texts)]


def test_components(table, copies):
    assert got(C.join(table(copies, label="1", node="'x'", num="2").repartition(4))) == brute(copies)


@pytest.mark.parametrize("classes", [((1, 1), (1 << 62, 2)), ((1, 1), (3, 2), (1 << 62, 3)), ((1 << 62, 1),)])
def test_classes_of_any_frequency(table, copies, monkeypatch, classes):
    """Combinations lose no link, whatever the classes."""
    monkeypatch.setattr(C, "CLASSES", classes)
    assert got(C.join(table(copies))) == brute(copies)


@pytest.mark.parametrize("classes", [((2, 1), (1 << 62, 2)), ((1, 1), (4, 2), (1 << 62, 3))])
def test_linked_sets_share_a_signature(classes):
    """Sets at the very threshold, of all sizes, with frequencies drawn at random."""
    draw = np.random.default_rng(3)
    met = 0
    for trial in range(1500):
        size = int(draw.integers(1, 300))
        every = draw.integers(1, 2**63, size + size // 9 + 2).astype(np.uint64)
        df = draw.integers(2, 9, len(every))
        lost = int(draw.integers(0, size // 10 + 1))
        a = np.arange(size)
        b = np.concatenate([np.arange(lost, size), np.arange(size, size + int(draw.integers(0, size // 10 + 1)))])
        common, union = size - lost, len(set(a) | set(b))
        if 100 * common < 90 * union:
            continue
        met += 1
        (x, x_short), (y, y_short) = (C.signatures(every[i], df[i], len(i), classes) for i in (a, b))
        if len(a) <= len(b):
            assert len(np.intersect1d(x[x_short], y)), (trial, size, lost)
        if len(b) <= len(a):
            assert len(np.intersect1d(x, y[y_short])), (trial, size, lost)
    assert met > 500


def test_one_big_group(table):
    """Hundreds of near copies of one text, of which links chain on; a third of the rows are equal."""
    base = prose.text(120, 1, 100_000)
    rows = [(i, prose.edit(base, 1, i), "en", "a") for i in range(1, 400)] + [(0, base, "en", "a")]
    rows += [(1000 + i, base, "en", "a") for i in range(200)]
    out = C.join(table(rows)).collect()
    assert {r.component_id for r in out} == {0}
    assert all(r.n_links > 0 for r in out)


def test_template_family(table):
    """Texts of one template that do not link, but for some pairs."""
    base = prose.text(200, 7, 100_000).split(" ")
    texts = [[*base[:90], *(f"own{i}x{k}" for k in range(8 + i % 9)), *base[110:]] for i in range(250)]
    texts += [[*texts[i][:91], f"new{i}", *texts[i][92:]] for i in range(0, 250, 5)]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]
    assert got(C.join(table(rows))) == brute(rows)


def test_hostile(hostile, nothing):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    assert got(C.join(hostile)) == brute(rows)
    assert C.join(nothing).count() == 0


def test_whole_table(spark):
    d, name = "/root/testdata/sf0.01", "op12_token_combinations"
    assert compare(QUERIES[name](spark, d), connect(d), SQL[name]) == 1000
