from collections import Counter, defaultdict

import numpy as np
import prose
import pytest

from chartloom.llm import probminhash as P
from chartloom.llm.components import components


def sets(text):
    words = prose.WORD.findall(text or "")
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def likeness(a, b):
    """The two similarities by their definitions."""
    both = set(a) | set(b)
    weighted = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in both) for d in set(a) & set(b))
    return weighted, len(set(a) & set(b)) / max(1, len(both))


def brute(rows):
    """Class of each row, from all pairs."""
    rows = [(doc, text, sets(text)) for doc, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][2] == rows[j][2] == Counter() or max(likeness(rows[i][2], rows[j][2])) >= 0.8:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc, _, _) in enumerate(rows):
        members[find(i)].append(doc)
    return sorted((doc, min(members[find(i)])) for i, (doc, _, _) in enumerate(rows))


@pytest.fixture(scope="module")
def copies():
    texts = [prose.text(150, i, 100_000) for i in range(25)]
    texts += [texts[0]] * 6 + ["  ".join(texts[1].split(" ")), "short", "short", "two words", None, "", " \n"]
    texts += [prose.edit(texts[2], 2, i) for i in range(12)]
    texts += [prose.edit(texts[3], 40, 1), " ".join([texts[4]] * 3), prose.edit(texts[5], 3, 9)]
    return [(100 - i, t, "en", "a") for i, t in enumerate(texts)]


def test_classes(table, copies):
    got = P.near_copies(table(copies)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute(copies)
    sizes = Counter(r.class_id for r in got)
    assert all(r.class_size == sizes[r.class_id] for r in got)
    kept = P.keep_one(table(copies, node="'own'"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(sizes)
    assert kept.columns[-1] == "node"


def test_exact_similarity():
    draw = np.random.default_rng(0)
    for _ in range(50):
        a, b = (Counter(draw.integers(0, 12, draw.integers(1, 30)).tolist()) for _ in range(2))

        def arrays(c):
            keys = np.array(sorted(c), np.uint64)
            return keys, np.array([c[int(k)] for k in keys])

        weighted, plain = likeness(a, b)
        assert P.similarity(arrays(a), arrays(b)) == pytest.approx(weighted)
        assert P.plain_similarity(arrays(a), arrays(b)) == pytest.approx(plain)


def test_registers_estimate_similarity():
    """Agreement of registers is the weighted similarity, on the mean."""
    draw = np.random.default_rng(1)
    agree, want = [], []
    for _ in range(60):
        keys = draw.integers(1, 2**63, 80).astype(np.uint64)
        x, y = draw.integers(1, 9, 80), draw.integers(1, 9, 80)
        a, b = (keys[:70], x[:70]), (keys[10:], y[10:])
        a, b = ((k[np.argsort(k)], w[np.argsort(k)]) for k, w in (a, b))
        agree.append((P.signature(*a) == P.signature(*b)).mean())
        want.append(P.similarity(a, b))
    assert np.mean(agree) == pytest.approx(np.mean(want), abs=0.03)


def test_early_termination_changes_nothing():
    """The registers of few elements with many arrivals, and of many, by plain simulation."""
    draw = np.random.default_rng(2)
    for n in (1, 3, 40, 3000):
        keys, weights = np.unique(draw.integers(1, 2**63, n).astype(np.uint64)), None
        weights = draw.integers(1, 5, len(keys))
        best, owner = np.full(P.REGISTERS, np.inf), np.zeros(P.REGISTERS, np.uint64)
        rounds = 6000 if n < 10 else 600 if n < 100 else 12
        clock = np.zeros(len(keys))
        for i in range(rounds):
            drawn = P.T.mix(keys + np.uint64(i) * P._GOLD)
            clock = clock - np.log(((drawn >> np.uint64(12)).astype(float) + 0.5) / 2.0**52) / weights
            register = (P.T.mix(drawn) % np.uint64(P.REGISTERS)).astype(int)
            for k, r, t in zip(keys, register, clock, strict=True):
                if t < best[r]:
                    best[r], owner[r] = t, k
        assert (P.signature(keys, weights) == owner).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_big_group(table):
    """Thousands of near copies of one text, from which links chain on."""
    base = prose.text(120, 1, 100_000)
    rows = [(i, prose.edit(base, 2, i), "en", "a") for i in range(1, 600)] + [(0, base, "en", "a")]
    got = P.near_copies(table(rows)).collect()
    assert {r.class_id for r in got} == {0}


def family(n, pairs):
    """Texts of one template, J 0.77 to each other, and a text at 0.81 for each number in ``pairs``."""
    base, texts = prose.text(200, 7, 100_000).split(" "), []
    for i in range(n):
        texts.append([*base[:90], *(f"own{i}x{k}" for k in range(21)), *base[111:]])
    texts += [[*texts[i][:95], *(f"new{i}x{k}" for k in range(16)), *base[111:]] for i in pairs]
    return [" ".join(t) for t in texts]


def test_large_bucket_of_many_components(table, monkeypatch):
    """Hundreds of nodes in a bucket, nearly all of them in components of their own."""
    monkeypatch.setattr(P, "FULL", 1)
    rows = [(i, t, "en", "a") for i, t in enumerate(family(300, range(0, 300, 6)))]
    got = P.near_copies(table(rows)).collect()
    want = {300 + k: i for k, i in enumerate(range(0, 300, 6))}
    assert {r.doc_id: r.class_id for r in got} == {i: want.get(i, i) for i in range(len(rows))}


def test_much_repeated_phrase(table):
    """Plain similarity 0.95, weighted one 0.25."""
    texts = [prose.text(200, i, 100_000) for i in range(8)]
    texts += [f"{t} {' '.join(prose.words(6, 50 + i) * 100)}" for i, t in enumerate(texts)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = P.near_copies(table(rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute(rows)
    assert {r.class_size for r in got} == {2}


def test_pairs_of_a_bucket_of_forty(spark):
    """All pairs are met, once, also where 38 of 64 registers agree."""
    rows = []
    for i in range(40):
        own = np.full(P.REGISTERS, 0, np.uint8)
        own[38:] = i + 1
        for band in (3, 5):
            rows.append((bytes([i]), own.view(np.int64).tolist(), None, bytes([i]), band, 1, 40, 40))
    kind = "node binary, sketch array<bigint>, plain array<bigint>, label binary, band int, value long, n long, central long"
    same = " ".join(f"w{i}" for i in range(50))
    texts = spark.createDataFrame([(bytes([i]), same) for i in range(40)], "node binary, text string")
    assert P._pairs(spark.createDataFrame(rows, kind), 1, texts).count() == 40 * 39 // 2


def test_bitmaps_leave_out_no_near_pair(spark):
    """The tests before texts are fetched hold for every pair that is near, with and without repeats."""
    draw = np.random.default_rng(4)
    rows, near = [], 0
    for _ in range(500):
        n = int(draw.integers(3, 500))
        keys = np.unique(draw.integers(1, 2**63, n + n // 20).astype(np.uint64))
        lost, new = draw.integers(0, n // 15 + 1, 2)
        heavy = draw.random() < 0.5
        weights = np.where(draw.random(len(keys)) < 0.1, draw.integers(1, 40, len(keys)), 1) if heavy else np.ones(len(keys), int)
        a, b = (keys[lost:n], weights[lost:n]), (np.concatenate([keys[: n - new], keys[n:]]), np.concatenate([weights[: n - new], weights[n:]]))
        if not len(a[0]) or not len(b[0]) or P.likeness(a, b) < P.SIMILARITY:
            continue
        near += 1
        row = []
        for e, w in (a, b):
            plain = P.sketch(P.signature(e, np.ones_like(w))).tolist() if w.max() > 1 else None
            row += [P.sketch(P.signature(e, w)).tolist(), plain, len(e), int(w.sum()), P.parity(e).tolist()]
        rows.append(row)
    kind = "sketch array<bigint>, plain array<bigint>, kinds long, mass long, bits array<bigint>"
    kinds = kind + ", " + ", ".join(f"p_{c}" for c in kind.split(", "))
    assert near > 150
    assert spark.createDataFrame(rows, kinds).where(P._can_be_near()).count() == near


def test_hostile(hostile, nothing):
    got = P.near_copies(hostile)
    assert got.count() == hostile.count()
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id not in (None, 7)}
    assert by_id[1].class_id == by_id[2].class_id == by_id[3].class_id == 1
    assert by_id[6].class_size == 2
    kept = P.keep_one(hostile)
    assert kept.columns == hostile.columns
    assert sum(r.doc_id == 6 for r in kept.collect()) == 1
    assert P.near_copies(nothing).count() == 0
    assert P.keep_one(nothing).count() == 0


def test_recall_on_given_documents(spark):
    """All pairs of the given table at 0.8 or more, by brute force over those that share an element."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, sets(r.text)) for r in docs.select("doc_id", "text").collect()]
    at = defaultdict(set)
    for i, (_, s) in enumerate(rows):
        for e in s:
            at[e].add(i)
    shared = Counter()
    for who in at.values():
        who = sorted(who)
        shared.update((a, b) for k, a in enumerate(who) for b in who[k + 1 :])
    near = [
        (rows[a][0], rows[b][0])
        for (a, b), c in shared.items()
        if 2 * c >= 0.5 * min(len(rows[a][1]), len(rows[b][1])) and max(likeness(rows[a][1], rows[b][1])) >= 0.8
    ]
    named = {r.doc_id: r.class_id for r in P.near_copies(docs).collect()}
    found = sum(named[a] == named[b] for a, b in near)
    assert len(near) > 50
    assert found >= 0.99 * len(near)
