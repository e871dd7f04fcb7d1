import math
from collections import Counter, defaultdict

import numpy as np
import prose
import pytest

from chartloom.llm import mixing


def brute_targets(sizes):
    """Sharing again and again, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.fixture(scope="module")
def rows():
    names = ["b", "a", None, "é", "Z", "aa", "c", "d"]
    out = []
    for i in range(900):
        source = names[0] if i % 3 == 0 else names[i % 8]
        out.append((i, prose.text(1 + i * 7 % 90, i) if i % 50 else None, "en", source))
    return out + [(5000, prose.text(3000, 1), "en", "c"), (5001, prose.text(2500, 2), "en", None)]


def test_targets_and_taken(table, rows, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 120)
    docs = table(rows)
    got = mixing.report(docs).collect()
    size = {doc: len(prose.WORD.findall(text or "")) for doc, text, *_ in rows}
    sources = {doc: source for doc, _, _, source in rows}
    total = Counter()
    for doc, n in size.items():
        total[sources[doc]] += n
    want, taken = brute_targets(total), defaultdict(int)
    assert sum(want.values()) == pytest.approx(1.5 * sum(total.values()))
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], total[sources[r.doc_id]])
        assert r.target == pytest.approx(want[sources[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        assert abs(r.copies - r.rate) < 1
        taken[sources[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(10, 0.005 * t)
    again = mixing.report(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    mixed = Counter(r.doc_id for r in mixing.mix(table(rows, copies="'own'")).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in got if r.copies})


def best_rates(sizes, target):
    """The numeric optimum for one source: the tilt by halving, on the definition."""
    words = [n for n in sizes if n]
    if target >= 2 * sum(words) * (1 - 1e-12):
        return {n: 2.0 for n in words}

    def taken(tilt):
        return sum(n * min(2.0, math.exp(min(700.0, tilt * n))) for n in words)

    low, high = -800.0, 800.0
    for _ in range(300):
        middle = (low + high) / 2
        low, high = (middle, high) if taken(middle) < target else (low, middle)
    return {n: min(2.0, math.exp(min(700.0, low * n))) for n in words}


def test_rates_are_the_optimum(table, rows):
    """Tilted by size: rates differ within a source, and are not the quotient of target and size."""
    got = mixing.report(table(rows)).collect()
    sources = {doc: source for doc, _, _, source in rows}
    own, target, whole = defaultdict(list), {}, {}
    for r in got:
        s = sources[r.doc_id]
        own[s].append(r.size)
        target[s], whole[s] = r.target, r.source_size
    want = {s: best_rates(sizes, target[s]) for s, sizes in own.items()}
    tilted = 0
    for r in got:
        s = sources[r.doc_id]
        if r.size:
            assert r.rate == pytest.approx(want[s][r.size], abs=2e-8)
            tilted += abs(r.rate - target[s] / whole[s]) > 0.01
    assert tilted > len(got) / 3
    due = Counter()
    for r in got:
        due[sources[r.doc_id]] += r.size * r.rate
    assert all(due[s] == pytest.approx(target[s], rel=1e-6) for s in due)
    # Less relative entropy to "each once" than any other rates with the same words.
    entropy = lambda rates: sum(x * math.log(x) - x + 1 if x > 0 else 1 for x in rates)
    for s, sizes in own.items():
        sizes = [n for n in sizes if n]
        flat = entropy([min(2.0, target[s] / whole[s])] * len(sizes))
        assert entropy([want[s][n] for n in sizes]) <= flat + 1e-9


def test_rounding():
    draw = np.random.default_rng(0)
    sizes = np.sort(draw.integers(1, 500, 300))[::-1]
    for rates in (np.full(300, 0.0), np.full(300, 0.31), np.full(300, 2.0), np.minimum(2, np.exp(sizes / 400)), np.exp(-sizes / 90)):
        for rows in (np.ones(300, int), draw.integers(1, 40, 300)):
            copies = mixing._copies(sizes, rates, rows)
            assert abs((copies * sizes).sum() - (rates * sizes * rows).sum()) <= 8
            assert (copies >= rows * np.floor(rates)).all() and (copies <= rows * np.ceil(rates)).all()


def test_a_third_of_the_rows_is_equal(table, monkeypatch):
    """Equal rows, with and without an id, are rounded as one with a count; other columns stay with them."""
    monkeypatch.setattr(mixing, "BLOCK", 50)
    rows = [(i, prose.text(1 + i % 40, i), "en", "ab"[i % 2]) for i in range(400)]
    rows += [(None, "some words of no id", "en", "a")] * 150 + [(7, "a repeated row", f"l{i % 3}", "b") for i in range(160)]
    docs = table(rows)
    got = mixing.report(docs).collect()
    assert len(got) == len(rows)
    taken, target = Counter(), {}
    sources = {i: "ab"[i % 2] for i in range(400)} | {None: "a"}
    for r in got:
        s = "b" if r.doc_id == 7 else sources[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
    assert all(abs(taken[s] - t) <= 0.01 * t + 20 for s, t in target.items())
    mixed = Counter((r.doc_id, r.text, r.lang, r.source) for r in mixing.mix(docs).collect())
    copies = Counter()
    for r in got:
        copies[r.doc_id, r.size] += r.copies
    again = Counter()
    for (doc, text, _, _), n in mixed.items():
        again[doc, len(prose.WORD.findall(text))] += n
    assert again == +copies
    assert {r.copies for r in got if r.doc_id is None} <= {0, 1, 2}
    repeated = [mixed[7, "a repeated row", f"l{k}", "b"] for k in range(3)]
    assert sum(repeated) == copies[7, 3] and max(repeated) <= 2 * 54


def test_hostile(hostile, nothing):
    got = mixing.report(hostile).collect()
    assert len(got) == hostile.count()
    mixed = mixing.mix(hostile)
    assert mixed.columns == hostile.columns
    copies = Counter()
    for r in got:
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +copies
    assert mixing.report(nothing).count() == mixing.mix(nothing).count() == 0
