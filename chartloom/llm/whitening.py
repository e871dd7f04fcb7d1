"""Whitening of embeddings: blockwise QR, bidiagonal form, dqds and twisted factorisations.

Every entry c of a vector becomes the whole number x = floor(256 * c). The fit list has each distinct
vector of x once: n vectors with sums S. Tasks centre their vectors, (n * x - S) / n, the numerator
in whole numbers, and reduce block after block to a triangle R; triangles meet in rounds of ``_fan``
until one is left, so nothing but triangles of the number of dimensions squared moves. R'R is n
times the covariance, which is never formed. R is reduced to a bidiagonal by Householder reflections from
both sides; dqds, which needs no subtraction but that of the shift, finds its singular values; the
eigenvectors of the bidiagonal's square come from twisted factorisations, each entered where the twist
is smallest, and are turned back by the right reflections.

Nulls and the like: a vector that is null or empty, or has a null, infinite or NaN entry (or one of 2**45
and more, which no whole number of 53 bits holds), is left out. Vectors have the length most of the others
have (of two such lengths the greater); others are left out. A null vec_id is carried; repeated rows
are returned as often as they come, and count once in the fit. A component of (numerically) no
variance has null whitened values; without any variance explained and identity_error are null as well. A
deviation of more than 63 bits is null. Fewer dimensions than components give fewer components. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import materialize

COMPONENTS = 4
SCALE = 256
#: Rows of a QR step, and bytes of triangles that meet in one task or in the driver.
BLOCK, MEETING = 4096, 32 << 20
_LOW = 26
_EPS = np.finfo(float).eps


def entries(df: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the rows that have one."""
    fits = F.forall(column, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < float(1 << 53)))
    x = F.transform(column, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    kept = df.where(F.col(column).isNotNull() & (F.size(column) > 0) & fits).select("vec_id", x.alias("x"))
    kept = materialize(kept, "vectors")
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c"))
    most = lengths.orderBy(F.desc("c"), F.desc("d")).first()
    return kept.where(F.size("x") == (most.d if most else 0))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(False).reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, high, low): sums of a dimension's upper and lower bits; dimension -1 counts rows."""
    n, high, low = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            x = _rows(batch)
            n, high, low = n + len(x), high + (x >> _LOW).sum(axis=0), low + (x & ((1 << _LOW) - 1)).sum(axis=0)
    if n:
        dims = np.arange(-1, len(high))
        parts = [dims, np.append(0, high), np.append(n, low)]
        yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["dim", "high", "low"])


def totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    parts = fit.mapInArrow(_sums, "dim long, high long, low long").groupBy("dim")
    found = {r.dim: (r.high << _LOW) + r.low for r in parts.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n = found.pop(-1, 0)
    return n, [found[i] for i in range(len(found))]


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64 bits where they suffice, else as Python's whole numbers."""
    largest = n * int(np.abs(x).max()) + max(map(abs, sums)) if x.size else 0
    if largest < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(over: np.ndarray) -> list[int | None]:
    """Sum of squares of each row of numerators; none if it has more than 63 bits."""
    if over.dtype != object and (not over.size or int(np.abs(over).max()) ** 2 * over.shape[1] < 1 << 63):
        return (over**2).sum(axis=1).tolist()
    exact = (over.astype(object) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _triangles(n: int, sums: list[int], block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, len(sums)))
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                over = numerators(_rows(batch.slice(at, block)), n, sums)
                r = _triangle(np.vstack([r, over.astype(float) / n]))
        if len(r):
            yield _packed(r)

    return reduce


def _packed(r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["r"])


def _meet(d: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for one in batch.column("r"):
                r = _triangle(np.vstack([r, np.frombuffer(one.as_buffer()).reshape(-1, d)]))
        if len(r):
            yield _packed(r)

    return meet


def _fan(d: int) -> int:
    """How many triangles may meet at once."""
    return max(2, min(64, MEETING // (8 * d * d)))


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list, square."""
    d = len(sums)
    parts = materialize(fit.mapInArrow(_triangles(n, sums, BLOCK), "r binary"), "triangles")
    while (left := parts.count()) > _fan(d):
        parts = parts.repartition(-(-left // _fan(d))).mapInArrow(_meet(d), "r binary")
        parts = materialize(parts, "triangles")
    return _triangle(np.vstack([np.zeros((d, d)), *(np.frombuffer(bytes(p.r)).reshape(-1, d) for p in parts.collect())]))


def _reflection(x: np.ndarray) -> np.ndarray | None:
    """v of unit length with x - 2 v v'x along the first axis; none where x is there already."""
    norm = np.linalg.norm(x)
    v = x.copy()
    v[0] += np.copysign(norm, x[0])
    length = np.linalg.norm(v)
    return v / length if norm and np.any(x[1:]) else None


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, the one above it b, and V, with r = U B V' for some U."""
    m, d = r.copy(), len(r)
    turned = np.eye(d)
    for k in range(d):
        if (v := _reflection(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2 and (v := _reflection(m[k, k + 1 :])) is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            turned[:, k + 1 :] -= 2 * np.outer(turned[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), turned


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One qd transformation with a shift; the least of the differences, negative if it is too large."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for i in range(len(e)):
        if least < 0:
            break
        top = d + e[i]
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    return [*new_q, d], new_e, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal with diagonal a and b above, largest first.

    Shifts are tried as a share of the least difference, an upper bound of the smallest value; too
    large a shift shows as a negative difference and is not taken. The bidiagonal is cut where an
    entry above the diagonal no longer counts.
    """
    small = (100 * _EPS) ** 2
    waiting = [((a**2).tolist(), (b**2).tolist(), 0.0)]
    found = []
    while waiting:
        q, e, moved = waiting.pop()
        share = 0.25
        while True:
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= small * (moved + min(q[-1], q[-2])):
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((i for i, x in enumerate(e) if x <= small * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                waiting += [(q[: cut + 1], e[:cut], moved), (q[cut + 1 :], e[cut + 1 :], moved)]
                break
            if q[0] < q[-1] / 2:  # small values belong at the end
                q, e = q[::-1], e[::-1]  # the transposed bidiagonal, read backwards
            _, _, most = _step(q, e, 0.0)
            shift = most * (1 - share)
            new_q, new_e, least = _step(q, e, shift)
            while least < 0:
                share = min(1.0, share * 4)
                shift = most * (1 - share) if share < 1 else 0.0
                new_q, new_e, least = _step(q, e, shift)
            share = max(share / 4, 1e-8)
            q, e, moved = new_q, new_e, moved + shift
    return np.sort(np.array(found))[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers from above and from below of B'B - value, and the twist of each place."""
    q, e, off, d = a**2, b**2, a[:-1] * b, len(a)
    tiny = _EPS * _EPS * max(value, np.max(q))
    down, up = np.zeros(d - 1), np.zeros(d - 1)
    s, p = np.empty(d), np.empty(d)
    s[0] = -value
    for i in range(d - 1):
        top = s[i] + q[i] or tiny
        down[i] = off[i] / top
        s[i + 1] = e[i] * (s[i] / top) - value
    p[-1] = q[-1] - value
    for i in range(d - 2, -1, -1):
        top = e[i] + p[i + 1] or tiny
        up[i] = off[i] / top
        p[i] = p[i + 1] * (q[i] / top) - value
    return down, up, s + p + value


def _entered(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    """The vector of the factorisation twisted at ``at``."""
    z = np.zeros(len(down) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, len(down)):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B for its ``values``, largest first, as columns. Of equal values the
    next vector is entered at the next smallest twist that gives a new direction."""
    out = []
    for value in values:
        down, up, twist = _twisted(a, b, float(value))
        best = None
        for at in np.argsort(np.abs(twist), kind="stable"):
            z = _entered(down, up, int(at))
            for _ in range(2):
                for before in out:
                    z = z - before * (before @ z)
            left = np.linalg.norm(z)
            if best is None or left > best[0]:
                best = (left, z / left if left else z)
            if left > 0.1:
                break
        out.append(best[1])
    return np.array(out).T


def components(r: np.ndarray, best: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """The greatest eigenvalues of r'r, their unit eigenvectors as columns, and its trace."""
    if not r.any():
        return np.zeros(min(best, len(r))), np.eye(len(r))[:, :best], 0.0
    scale = float(np.abs(r).max())
    a, b, turned = bidiagonal(r / scale)
    values = dqds(a, b)[:best]
    vectors = turned @ directions(a, b, values)
    return values * scale**2, vectors, float((r**2).sum())


def _whitener(n: int, sums: list[int], axes: np.ndarray, scales: np.ndarray):
    """Numerators and whitened values of vectors; one without a scale has no number."""

    def apply(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        over = numerators(x, n, sums)
        with np.errstate(divide="ignore", invalid="ignore"):
            return over, (over.astype(float) / n) @ axes / scales

    return apply


def _whitened(apply, scales: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(vec_id, component, deviation, whitened) of (vec_id, x)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(scales)
        for batch in batches:
            if not batch.num_rows:
                continue
            over, white = apply(_rows(batch))
            each = pa.array(np.repeat(np.arange(batch.num_rows), k))
            none = np.tile(scales == 0, batch.num_rows)
            columns = [
                batch.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(deviations(over), pa.int64()).take(each),
                pa.array(white.ravel(), pa.float64(), mask=none),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "deviation", "whitened"])

    return rows


def _moments(apply, means: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(i, v): sums of the whitened values or, less their ``means``, of the products of each two."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                white = apply(_rows(batch))[1]
                total = total + (white.sum(axis=0) if means is None else ((white - means).T @ (white - means)).ravel())
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    return add


def _summed(fit: DataFrame, add, size: int) -> np.ndarray:
    out = np.zeros(size)
    for row in fit.mapInArrow(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row.i] = row.v
    return out


def whiten(df: DataFrame, column: str = "embedding", best: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row that has a
    vector, for each of the ``best`` components."""
    kind = df.schema["vec_id"].dataType.simpleString()
    vectors = entries(df, column)
    fit = materialize(vectors.select("x").distinct(), "fit")
    n, sums = totals(fit)
    if not n:
        empty = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    values, axes, trace = components(triangle(fit, n, sums), best)
    rank = int((values > (8 * len(sums) * _EPS) ** 2 * values[0]).sum()) if trace else 0
    scales = np.where(np.arange(len(values)) < rank, np.sqrt(values / n), 0.0)
    error = None
    if rank:
        apply = _whitener(n, sums, axes[:, :rank], scales[:rank])
        means = _summed(fit, _moments(apply, None), rank) / n
        spread = _summed(fit, _moments(apply, means), rank * rank).reshape(rank, rank) / n
        error = float(np.abs(spread - np.eye(rank)).max())
    rows = vectors.mapInArrow(
        _whitened(_whitener(n, sums, axes, scales), scales),
        f"vec_id {kind}, component int, deviation long, whitened double",
    )
    shares = F.array(*(F.lit(float(v / trace) if trace else None).cast("double") for v in values))
    return rows.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
