import math
from collections import Counter

import numpy as np
import pytest

from chartloom.llm import whitening as H
from chartloom.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def brute(rows, best=4):
    """By the definition: exact covariance, then the library's symmetric eigenvalues."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max(Counter(len(v) for _, v in ok).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in ok if len(v) == d]
    fit = np.array(sorted({x for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    over = n * fit - sums
    cov = (over.T @ over).astype(float) / float(n) ** 3
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:best], vectors[:, ::-1][:, :best]
    out = {}
    for i, x in kept:
        dev = n * np.array(x, dtype=object) - sums
        out.setdefault(i, []).append((int((dev**2).sum()), (dev / n).astype(float) @ vectors / np.sqrt(values)))
    return n, values / np.trace(cov), out


def check(rows, got, n_rows):
    n, explained, want = brute(rows)
    assert len(got) == n_rows * min(4, len(explained))
    signs = {}
    for r in got:
        k = r.component - 1
        close = [w for w in want[r.vec_id] if w[0] == r.deviation]
        assert close and r.n == n
        assert r.explained == pytest.approx(explained[k], rel=1e-9)
        assert r.identity_error < 1e-9
        white = close[0][1][k]
        if abs(white) > 1e-3:
            signs.setdefault(k, r.whitened * white > 0)
            assert r.whitened == pytest.approx(white if signs[k] else -white, abs=1e-8)


def frame(spark, rows, **extra):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name, value in extra.items():
        df = df.selectExpr("*", f"{value} AS `{name}`")
    return df


def spread(n, d, seed):
    draw = np.random.default_rng(seed)
    scale = np.linspace(3, 0.2, d)
    return (draw.normal(size=(n, d)) * scale @ np.linalg.qr(draw.normal(size=(d, d)))[0] + 1.5).tolist()


def test_against_brute_force(spark):
    rows = list(enumerate(spread(700, 12, 1)))
    rows += [(1000 + i, rows[3][1]) for i in range(300)] + [(5, rows[5][1])]
    got = H.whiten(frame(spark, rows, x="1", n="2", component="'c'").repartition(7)).collect()
    check(rows, got, len(rows))


def test_many_triangles(spark, monkeypatch):
    """Triangles meet in rounds, rows in blocks."""
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "MEETING", 1)
    rows = list(enumerate(spread(300, 5, 2)))
    check(rows, H.whiten(frame(spark, rows).repartition(9)).collect(), len(rows))


def test_hostile(spark):
    rows = [(i, v) for i, v in enumerate(spread(60, 6, 3))]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [NAN] * 6), (104, [INF] + [0.0] * 5)]
    bad += [(105, [1.0, 2.0]), (106, [1e300] * 6), (None, rows[1][1]), (7, rows[2][1]), (8, [0.0] * 6), (9, [-0.0] * 6)]
    df = frame(spark, rows + bad)
    got = H.whiten(df).collect()
    kept = rows + [b for b in bad if b[0] not in range(100, 107)]
    check(kept, got, len(kept))
    assert H.whiten(df.where("false")).count() == 0
    assert H.whiten(df.where("vec_id between 100 and 104")).count() == 0


def test_no_variance(spark):
    same = H.whiten(frame(spark, [(1, [1.0, 2.0, 3.0, 4.0, 5.0])] * 3)).collect()
    assert len(same) == 12
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in same)
    line = H.whiten(frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])).collect()
    assert len(line) == 15
    assert all((r.whitened is not None) == (r.component == 1) for r in line)
    assert {round(r.explained, 9) for r in line if r.component == 1} == {1.0}
    assert all(r.identity_error < 1e-12 for r in line)


def test_exact_deviations():
    """Beyond 64 bits numbers are Python's, and a sum that no long holds is null."""
    x = np.array([[1 << 50, 3], [-(1 << 50), 5]], np.int64)
    over = H.numerators(x, 10**6, [0, 8])
    assert over[0][0] == (1 << 50) * 10**6
    assert H.deviations(over) == [None, None]
    small = H.numerators(np.array([[1 << 20, 3]], np.int64), 1000, [5, 8])
    assert H.deviations(small) == [(1000 * (1 << 20) - 5) ** 2 + (3000 - 8) ** 2]


@pytest.mark.parametrize("d", [1, 2, 3, 17, 60])
def test_singular_values(d):
    draw = np.random.default_rng(d)
    for _ in range(8):
        r = np.triu(draw.normal(size=(d, d))) * 10.0 ** draw.integers(-3, 3, d)
        a, b, turned = H.bidiagonal(r)
        assert np.allclose(turned.T @ turned, np.eye(d), atol=1e-13)
        full = np.diag(a) + np.diag(b, 1)
        assert np.allclose(turned @ full.T @ full @ turned.T, r.T @ r, atol=1e-12 * np.abs(r).max() ** 2 * d)
        got = np.sqrt(H.dqds(a, b))
        want = np.linalg.svd(full, compute_uv=False)
        assert np.allclose(got, want, rtol=1e-12, atol=1e-14 * want[0])


def test_small_singular_values_are_accurate():
    """Relative accuracy of a graded bidiagonal: the product of all values is that of the diagonal."""
    a, b = 10.0 ** -np.arange(0, 40, 2.0), 0.7 * 10.0 ** -np.arange(0, 38, 2.0)
    got = H.dqds(a, b)
    assert np.log(got).sum() == pytest.approx(2 * np.log(a).sum(), rel=1e-14)
    assert (got > 0).all()


def test_singular_values_of_zero_and_equal_ones():
    assert H.dqds(np.array([1.0, 0.0, 2.0]), np.array([0.5, 0.0])).tolist()[-1] < 1e-30
    assert H.dqds(np.ones(9), np.zeros(8)).tolist() == [1.0] * 9
    a, b = np.ones(30), np.full(29, 1e-9)
    vectors = H.directions(a, b, H.dqds(a, b)[:4])
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    check(rows, QUERIES["op13_qd_whitening"](spark, d).collect(), len(rows))
