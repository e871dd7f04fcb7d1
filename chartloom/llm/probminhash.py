"""Near copies by ProbMinHash signatures of weighted word shingles, banding and verification.

A text's elements are its windows of five words (a shorter text is one element), weighted by how
often they occur. Every element is a Poisson process whose rate is its weight: arrivals come at
exponential gaps drawn from the element's hash, each falls on one register, and a register keeps
the element that arrives first. An element is dropped once its next arrival is later than the
latest register, so long texts cost little more than one arrival per element. Two texts agree on a
register with the probability Jaccard similarity

    J = sum over common d of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d]).

That can be far below the plain Jaccard similarity of the distinct elements where one element occurs
very often, so a text with repeated elements has a second signature, with all weights 1. Both cut into
bands of the same kind, as without repeated elements the two are the same.

Equal texts (same words) become one node first. Nodes that share a band are candidates; each is
compared, on whole texts, with the most central text of its bucket. A pair is linked where the exact
J, or the exact Jaccard similarity of the distinct elements, reaches 0.8; pairs whose registers agree
far too little for that are not fetched. Only buckets whose members are then still in different
components go on: buckets of up to 64 members in full, larger ones by a prefix filter (see ``_rest``),
which meets every pair that can reach 0.8. Members of one component are never compared again, so copies are not expanded
into pairs. Classes are the components of the links.

Nulls: a null text is an empty one; texts without a word are equal to each other. A null doc_id is
carried, and never names a class that has another id. Repeated rows are equal texts. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm import text as T
from chartloom.llm.components import components
from chartloom.llm.prefilter import may_be_in
from chartloom.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
REGISTERS = BANDS * ROWS
#: Nodes of a bucket up to which all its pairs are told apart by their sketches and bitmaps; larger
#: buckets go through a prefix filter first.
FULL = 4096
#: Bits of the parity bitmaps.
PARITY_BITS = 2048
#: Of the 64 registers, how many must agree in their last byte for a pair to be compared. At a
#: similarity of 0.8 fewer do with a chance of four in a million.
AGREEING = 36
#: Elements of texts that a verifying task keeps at hand, as a pivot meets many texts.
RECENT_BYTES = 32 << 20
#: What is compared of two nodes before their texts are: with a pivot, and where all are compared.
COMPARED = ("sketch", "plain")
DETAIL = ("kinds", "mass", "bits")
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: T.Words, hashes: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements of text ``i`` and their weights."""
    own = hashes[words.first[i] : words.first[i + 1]]
    if not len(own):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(SHINGLE, len(own))
    found = T.window_hashes(own, np.arange(len(own) - size + 1), size)
    return np.unique(found, return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The element that reaches each register first."""
    first = np.full(REGISTERS, np.inf)
    owner = np.zeros(REGISTERS, np.uint64)
    clock = np.zeros(len(elements))
    number = 0
    while len(elements):
        block = max(1, 6 * REGISTERS // len(elements))
        steps = np.arange(number, number + block, dtype=np.uint64) * _GOLD
        drawn = T.mix(elements[:, None] + steps[None, :])
        gap = -np.log(((drawn >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52)
        arrival = clock[:, None] + np.cumsum(gap, axis=1) / weights[:, None]
        clock, number = arrival[:, -1], number + block
        latest = first.max()
        time, register = arrival.ravel(), (T.mix(drawn) % np.uint64(REGISTERS)).ravel()
        source = np.repeat(elements, block)
        if np.isinf(latest) and len(time) > 8 * REGISTERS:
            latest = np.partition(time, 8 * REGISTERS)[8 * REGISTERS]
        soon = time < latest if np.isfinite(latest) else np.ones(len(time), bool)
        _settle(first, owner, time[soon], register[soon], source[soon])
        rest = ~soon & (time < first.max())
        if rest.any():
            _settle(first, owner, time[rest], register[rest], source[rest])
        going = clock < first.max()
        elements, weights, clock = elements[going], weights[going], clock[going]
    return owner


def _settle(first, owner, time, register, source) -> None:
    order = np.argsort(time, kind="stable")[::-1]
    time, register, source = time[order], register[order], source[order]
    earliest = np.full(REGISTERS, np.inf)
    by = np.zeros(REGISTERS, np.uint64)
    earliest[register], by[register] = time, source
    sooner = earliest < first
    first[sooner], owner[sooner] = earliest[sooner], by[sooner]


def bands(owner: np.ndarray) -> np.ndarray:
    value = np.arange(BANDS, dtype=np.uint64) * _GOLD
    for row in owner.reshape(BANDS, ROWS).T:
        value = T.mix(value ^ row)
    return value.view(np.int64)


def sketch(owner: np.ndarray) -> np.ndarray:
    """The last byte of each register, eight to a number."""
    return (T.mix(owner) & np.uint64(0xFF)).astype(np.uint8).view(np.int64)


def _agreeing(a: str, b: str) -> Column:
    """How many bytes two sketches have in common, by bit operations on whole numbers."""
    folded = "x"
    for shift in (4, 2, 1):
        folded = f"({folded} | shiftrightunsigned({folded}, {shift}))"
    differing = f"bit_count({folded} & 72340172838076673)"  # 0x0101010101010101
    words = f"zip_with({a}, {b}, (x, y) -> x ^ y)"
    return F.expr(f"{REGISTERS} - aggregate({words}, 0, (n, x) -> n + {differing})")


def parity(elements: np.ndarray) -> np.ndarray:
    """Of each of ``PARITY_BITS`` bits whether an odd number of elements falls on it: two sets differ in
    as many elements, at least, as these bits do."""
    fallen = np.bincount((T.mix(elements ^ _GOLD) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((fallen & 1).astype(bool)).view(np.int64)


def _agree() -> tuple[Column, Column]:
    """Whether enough registers agree, by the plain similarity and, where it is another, the weighted one.
    ``plain`` is null where both are the same."""
    other = F.col("plain").isNotNull() | F.col("p_plain").isNotNull()
    plain = _agreeing("coalesce(plain, sketch)", "coalesce(p_plain, p_sketch)") >= AGREEING
    return plain, other & (_agreeing("sketch", "p_sketch") >= AGREEING)


def _can_be_near() -> Column:
    """Whether so many elements can be in common, by sizes and bitmaps, that the bound of a similarity
    allows it, and enough registers agree. The first is the cheaper test, and nearly all pairs end there.

    With c common elements at most, c = (sizes - differing bits) / 2. The plain similarity is c / (sizes - c).
    For the other (see ``_rest``), 1/a + 1/b >= 4 / (a + b), and an element that is not in common takes
    a weight of 1 at least from its text's share. Both turn into a greatest number of differing bits.
    """
    quick = F.expr(" + ".join(f"bit_count(get(bits, {i}) ^ get(p_bits, {i}))" for i in range(PARITY_BITS // 64)))
    differing = F.expr("aggregate(zip_with(bits, p_bits, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)")
    both = F.col("kinds") + F.col("p_kinds")
    share = (1 - SIMILARITY) / (1 + SIMILARITY)
    sizes = F.least("kinds", "p_kinds") >= SIMILARITY * F.greatest("kinds", "p_kinds")
    many = F.when(sizes, both * share + 1e-6)
    lost = F.col("kinds") / F.col("mass") + F.col("p_kinds") / F.col("p_mass") - 2 * share
    other = F.col("plain").isNotNull() | F.col("p_plain").isNotNull()
    heavy = F.when(other, both - 2 * lost / (1 / F.col("mass") + 1 / F.col("p_mass")) + 1e-6)
    by_plain, by_weight = _agree()
    allowed = F.coalesce(F.greatest(many, heavy), F.lit(-1.0))
    return (quick <= allowed) & (((differing <= many) & by_plain) | ((differing <= heavy) & by_weight))


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node of each text, next to the columns that come in."""
    for batch in T.slices(batches):
        words = T.words_of(batch)
        hashes, first = words.hashes(), words.first
        nodes = [_digest(hashes[first[i] : first[i + 1]]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nodes, pa.binary())], names=[*batch.schema.names, "node"]
        )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        words = T.words_of(batch)
        hashes, first = words.hashes(), words.first
        nodes, found, sketches, plains = [], [], [], []
        for i in range(batch.num_rows):
            nodes.append(_digest(hashes[first[i] : first[i + 1]]))
            elements, weights = shingles(words, hashes, i)
            owner = signature(elements, weights) if len(elements) else None
            found.append([] if owner is None else bands(owner).tolist())
            sketches.append([] if owner is None else sketch(owner).tolist())
            plains.append(None)
            if owner is not None and weights.max() > 1:
                plain = signature(elements, np.ones_like(weights))
                found[-1] += bands(plain).tolist()
                plains[-1] = sketch(plain).tolist()
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (found, sketches, plains)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(nodes, pa.binary()), *lists],
            names=["doc_id", "node", "bands", "sketch", "plain"],
        )


def _details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, kinds, mass, bits) of (node, text): how many elements, all weights, the bitmap."""
    for batch in T.slices(batches):
        words = T.words_of(batch)
        hashes = words.hashes()
        sets = [shingles(words, hashes, i) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array([len(x) for x, _ in sets], pa.int64()),
                pa.array([int(w.sum()) for _, w in sets], pa.int64()),
                pa.array([parity(x) for x, _ in sets], pa.list_(pa.int64())),
            ],
            names=["node", *DETAIL],
        )


def plain_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact Jaccard similarity of the distinct elements."""
    common = len(_common(a, b)[0])
    return common / max(1, len(a[0]) + len(b[0]) - common)


def _common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common elements in both; elements are sorted."""
    if not len(a[0]) or not len(b[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    to = np.searchsorted(b[0], a[0])
    at = np.flatnonzero(b[0][np.minimum(to, len(b[0]) - 1)] == a[0])
    return at, to[at]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two sets of (elements, weights)."""
    at, bt = _common(a, b)
    if not len(at):
        return 0.0
    x, y = a[1][at].astype(float), b[1][bt].astype(float)
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    from_x = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]]) + only_x
    upto_y = np.concatenate([[0.0], np.cumsum(y)]) + only_y
    low = np.searchsorted(ratio, ratio, "left")
    return float(np.sum(1.0 / (from_x[low] / x + upto_y[low] / y)))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The plain similarity or, where that is under ``SIMILARITY``, the other one; a bound of it (see
    ``_rest``) where that is under as well."""
    at, bt = _common(a, b)
    plain = len(at) / max(1, len(a[0]) + len(b[0]) - len(at))
    if plain >= SIMILARITY or not len(at):
        return plain
    bound = 1.0 / (a[1].sum() / a[1][at].sum() + b[1].sum() / b[1][bt].sum() - 1.0)
    return bound if bound < SIMILARITY - 1e-9 else similarity(a, b)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The likeness of each (a, b, text_a, text_b); elements of recent pivots are kept at hand."""
    recent: OrderedDict[bytes, tuple] = OrderedDict()
    held = 0

    def elements(node, text):
        nonlocal held
        if node not in recent:
            words = T.Words(*T.texts(pa.array([text], pa.large_string())))
            recent[node] = found = shingles(words, words.hashes(), 0)
            held += found[0].nbytes * 2
            while held > RECENT_BYTES and len(recent) > 2:
                held -= recent.popitem(last=False)[1][0].nbytes * 2
        recent.move_to_end(node)
        return recent[node]

    for batch in T.slices(batches, "text_b"):
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "b", "text_b")), strict=True)
        like = []
        for a, text_a, b, text_b in rows:
            like.append(likeness(elements(a, text_a), elements(b, text_b)))
        kept = batch.select(["a", "a_label", "b", "b_label"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(like, pa.float64())], names=[*kept.schema.names, "likeness"]
        )


def _shared(found: DataFrame) -> DataFrame:
    """(node, ``COMPARED``, band, value, n) of all bands that several nodes have in common: ``n``."""
    banded = found.select("node", *COMPARED, F.posexplode("bands").alias("band", "value"))
    banded = banded.withColumn("band", F.col("band") % BANDS).dropDuplicates(["node", "band", "value"])
    common = banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    return banded.join(common, ["band", "value"])


def _central(members: DataFrame) -> DataFrame:
    """``members`` with how many nodes each shares its bands with, most for a text that others
    were made from."""
    central = members.groupBy("node").agg(F.sum("n").alias("central"))
    return members.join(central, "node")


def _open(members: DataFrame) -> DataFrame:
    """``members`` of buckets that several components meet in, with the bucket's largest: ``main``."""
    parts = members.groupBy("band", "value", "label").agg(F.count("*").alias("c"))
    open_ = parts.groupBy("band", "value").agg(
        F.max(F.struct("c", "label"))["label"].alias("main"), F.count("*").alias("parts")
    )
    return members.join(open_.where("parts > 1"), ["band", "value"])


def _pairs(members: DataFrame, number: int, texts: DataFrame, full: int = FULL) -> DataFrame:
    """Pairs of different components in unsettled buckets, whose sketches agree enough. In round 0 the members
    meet the pivot of their bucket, its most central text; in round 1 all members of buckets of up to ``full``
    each other. Larger ones go on in ``_rest``.

    ``members``: node, ``COMPARED``, label, band, value, n, central.
    """
    if number:
        left = materialize(_open(members.where(F.col("n") <= full)), "apart")
        bucket = F.xxhash64("band", "value")
        own = left.groupBy("node").agg(F.collect_set(bucket).alias("buckets"))
        left = _detailed(left.join(own, "node").withColumn("bucket", bucket), texts)
        left = left.withColumn("outside", F.col("label") != F.col("main"))
        columns = ["node", "label", "outside", "bucket", "buckets", *COMPARED, *DETAIL]
        groups = left.select("band", "value", *columns).groupBy("band", "value")
        return groups.applyInArrow(_bucket_pairs, "a binary, b binary, a_label binary, b_label binary").distinct()
    place = F.row_number().over(W.partitionBy("band", "value").orderBy(F.desc("central"), "node"))
    p = members.withColumn("place", place).where("place = 1").select(
        F.col("band").alias("p_band"),
        F.col("value").alias("p_value"),
        F.col("node").alias("p"),
        F.col("label").alias("p_label"),
        *(F.col(c).alias(f"p_{c}") for c in COMPARED),
    )
    same = (F.col("band") == F.col("p_band")) & (F.col("value") == F.col("p_value"))
    by_plain, by_weight = _agree()
    return _ordered(members.join(p, same & (F.col("label") != F.col("p_label")) & (by_plain | by_weight)))


def _rows(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Lists of one length as rows of an array."""
    column = column.combine_chunks()
    return column.flatten().to_numpy(False).view(kind).reshape(len(column), -1)


def _bucket_pairs(bucket: pa.Table) -> pa.Table:
    """The pairs of one bucket, of ``FULL`` members at most, that may be near: the tests of ``_can_be_near``.
    Members of the largest component meet the others only. A pair that shares several buckets comes
    from one of them, that of the least number."""
    nodes, labels = (bucket.column(c).to_pylist() for c in ("node", "label"))
    sketch, bits = _rows(bucket.column("sketch"), np.uint8), _rows(bucket.column("bits"), np.uint64)
    has_plain = bucket.column("plain").is_valid().to_numpy()
    plain = sketch.copy()
    if has_plain.any():
        plain[has_plain] = _rows(bucket.column("plain").drop_null(), np.uint8)
    kinds, mass, outside = (bucket.column(c).to_numpy() for c in ("kinds", "mass", "outside"))
    own = bucket.column("bucket")[0].as_py()
    shared = [set(x) for x in bucket.column("buckets").to_pylist()]
    part = np.unique(np.array(labels, object), return_inverse=True)[1]
    share = (1 - SIMILARITY) / (1 + SIMILARITY)
    found = []
    for i in range(len(nodes) - 1):
        j = i + 1 + np.flatnonzero((part[i + 1 :] != part[i]) & (outside[i + 1 :] | outside[i]))
        if not len(j):
            continue
        differing = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
        both = kinds[j] + kinds[i]
        alike = np.minimum(kinds[j], kinds[i]) >= SIMILARITY * np.maximum(kinds[j], kinds[i])
        lost = kinds[j] / mass[j] + kinds[i] / mass[i] - 2 * share
        many = alike & (differing <= both * share + 1e-6)
        heavy = (has_plain[j] | has_plain[i]) & (differing <= both - 2 * lost / (1 / mass[j] + 1 / mass[i]) + 1e-6)
        some = many | heavy
        j, many, heavy = j[some], many[some], heavy[some]
        agree = many & ((plain[j] == plain[i]).sum(axis=1) >= AGREEING)
        agree |= heavy & ((sketch[j] == sketch[i]).sum(axis=1) >= AGREEING)
        for k in j[agree].tolist():
            if min(shared[i] & shared[k]) == own:
                a, b = (i, k) if nodes[i] < nodes[k] else (k, i)
                found.append((nodes[a], nodes[b], labels[a], labels[b]))
    columns = list(zip(*found, strict=True)) or [[]] * 4
    return pa.table({n: pa.array(c, pa.binary()) for n, c in zip(("a", "b", "a_label", "b_label"), columns, strict=True)})


def _detailed(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` with the ``DETAIL`` of their nodes, stored."""
    rows = materialize(rows, "apart")
    wanted = texts.join(rows.select("node").distinct(), "node", "left_semi").select("node", "text")
    detail = materialize(wanted.mapInArrow(_details, "node binary, kinds long, mass long, bits array<bigint>"), "details")
    return materialize(rows.join(detail, "node"), "apart")


def _ordered(met: DataFrame) -> DataFrame:
    """Each pair (node, p) once, smaller node first."""
    first = F.col("node") < F.col("p")
    return met.select(
        F.when(first, F.col("node")).otherwise(F.col("p")).alias("a"),
        F.when(first, F.col("p")).otherwise(F.col("node")).alias("b"),
        F.when(first, F.col("label")).otherwise(F.col("p_label")).alias("a_label"),
        F.when(first, F.col("p_label")).otherwise(F.col("label")).alias("b_label"),
    ).distinct()


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, element, weight, of_mass, of_kinds) of (node, text): all weights and all elements of it."""
    for batch in T.slices(batches):
        words = T.words_of(batch)
        hashes = words.hashes()
        for i in range(batch.num_rows):
            elements, weights = shingles(words, hashes, i)
            n = len(elements)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column("node")[i].as_py()] * n, pa.binary()),
                    pa.array(elements.view(np.int64)),
                    pa.array(weights.astype(np.int64)),
                    pa.array(np.full(n, weights.sum(), np.int64)),
                    pa.array(np.full(n, n, np.int64)),
                ],
                names=["node", "element", "weight", "of_mass", "of_kinds"],
            )


def _rest(members: DataFrame, texts: DataFrame, full: int = FULL) -> DataFrame:
    """Pairs of different components in buckets of more than ``full`` nodes, all that can reach
    ``SIMILARITY`` t among those whose sketches agree enough.

    With shares a and b of two texts' weights on common elements, J is 1 / (1/a + 1/b - 1) at most
    (and is that for the plain similarity, with shares of the distinct elements). In any common order of
    elements, the first common one has at least these shares of the texts at and after it, so the pair
    meets there, with shares that allow t, by one similarity or the other. Rare elements come first, so
    that what a template's texts all have in common brings together only those near t. An element of
    one text alone is in no pair and only takes its place in the order.
    """
    left = _open(members.where(F.col("n") > full))
    nodes = left.groupBy("node").agg(
        F.first("label").alias("label"),
        *(F.first(c).alias(c) for c in COMPARED),
        F.max(F.col("label") != F.col("main")).alias("outside"),
    )
    nodes = _detailed(nodes, texts)
    own = texts.join(nodes.select("node"), "node").select("node", "text").mapInArrow(
        _elements, "node binary, element long, weight long, of_mass long, of_kinds long"
    )
    own = materialize(own, "elements")
    common = own.groupBy("element").agg(F.count("*").alias("df")).where("df > 1")
    behind = W.partitionBy("node").orderBy("df", "element").rowsBetween(0, W.unboundedFollowing)
    shares = {
        "heavy": F.sum("weight").over(behind) / F.col("of_mass") + 1e-9,
        "many": F.count("*").over(behind) / F.col("of_kinds") + 1e-9,
    }
    prefix = own.join(common, "element").withColumns(shares)
    prefix = prefix.where(F.greatest("heavy", "many") >= SIMILARITY).select("node", "element", *shares)
    prefix = materialize(prefix.join(nodes, "node"), "prefixes")
    p = prefix.select(
        F.col("node").alias("p"), *(F.col(c).alias(f"p_{c}") for c in ("element", "label", *shares, *COMPARED, *DETAIL))
    )
    reach = [1 / F.col(c) + 1 / F.col(f"p_{c}") - 1 <= 1 / SIMILARITY for c in shares]
    same = (F.col("element") == F.col("p_element")) & (reach[0] | reach[1])
    return _ordered(prefix.where("outside").join(p, same & (F.col("label") != F.col("p_label")) & _can_be_near()))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) for (node, owner): one text per node, that of the row with the owner's id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    with_node = docs.select("doc_id", "text").mapInArrow(
        _nodes, f"doc_id {kind}, text string, node binary"
    )
    with_node = may_be_in(with_node, "node", wanted, "_wanted").where("_wanted")
    w = wanted.select(F.col("node").alias("w"), "owner")
    same = (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("owner"))
    return with_node.join(w, same).select("node", "text")


def _links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose exact similarity reaches ``SIMILARITY``."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    found = pairs.join(a, "a").join(b, "b").select(
        "a", "a_label", "b", "b_label", "text_a", "text_b"
    )
    return (
        found.mapInArrow(
            _verify, "a binary, a_label binary, b binary, b_label binary, likeness double"
        )
        .where(F.col("likeness") >= SIMILARITY)
        .distinct()
    )


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id of the class), class_size, n_links (verified links of the
    text's node), node (digest of the words) and first (the node whose text has the smallest id)
    for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = materialize(
        docs.select("doc_id", "text").mapInArrow(
            _signatures, f"doc_id {kind}, node binary, bands array<bigint>, sketch array<bigint>, plain array<bigint>"
        ),
        "signatures",
    )
    owners = materialize(
        found.groupBy("node").agg(F.min("doc_id").alias("owner"), F.count("*").alias("copies")),
        "owners",
    )
    members = materialize(_shared(found), "members")
    members = materialize(_central(members).withColumn("label", F.col("node")), "members")
    wanted = materialize(owners.join(members.select("node").distinct(), "node"), "wanted")
    texts = materialize(_texts(docs, wanted), "texts")
    degrees, compared = [], None
    for number in range(3):
        pairs = _pairs(members, number, texts, FULL) if number < 2 else _rest(members, texts, FULL)
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if pairs.isEmpty():
            continue
        links = materialize(_links(texts, pairs), "links")
        if not links.isEmpty():
            degrees.append(links.select(F.explode(F.array("a", "b")).alias("node")))
            merged = components(links.select(F.col("a_label").alias("u"), F.col("b_label").alias("v")))
            merged = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
            members = materialize(
                members.join(merged, "label", "left")
                .withColumn("label", F.coalesce("to", "label"))
                .drop("to"),
                "members",
            )
        done = pairs.select("a", "b")
        compared = done if compared is None else compared.unionByName(done)
    labels = members.select("node", "label").distinct()
    named = owners.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rank = F.struct(F.col("owner").isNull().alias("none"), "owner", "node")
    sizes = named.groupBy("label").agg(
        F.min(rank).alias("first"), F.sum("copies").alias("class_size")
    )
    ends = reduce(DataFrame.unionByName, degrees) if degrees else owners.select("node").limit(0)
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    per_node = materialize(
        named.join(sizes, "label")
        .join(degree, "node", "left")
        .select(
            "node",
            F.col("first.owner").alias("class_id"),
            F.col("first.node").alias("first"),
            "class_size",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "classes",
    )
    return found.select("doc_id", "node").join(per_node, "node")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links of every row."""
    return classes(docs).select("doc_id", "class_id", "class_size", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class: the one with the smallest id, of several such rows with
    the same words the first by text. A class without any id keeps one row as well."""
    rows = materialize(
        classes(docs).select(
            "doc_id",
            "node",
            ((F.col("node") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
        ),
        "kept",
    )
    gone = rows.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("node").alias("_gone")).distinct()
    gone = materialize(gone.withColumn("_key", F.xxhash64("_id", "_gone")), "gone")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0), *(f"`{c}`" for c in rest)).alias("rest"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema)
    with_node = packed.mapInArrow(_nodes, f"{kinds}, node binary").withColumn("_key", F.xxhash64("doc_id", "node"))
    with_node = may_be_in(with_node, "_key", gone, "_may_go").drop("_key")
    same = (F.col("node") == F.col("_gone")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    stays = with_node.where("_may_go").join(gone.drop("_key"), same, "left_anti")
    left = stays.unionByName(with_node.where("NOT _may_go")).drop("_may_go")
    repeated = rows.where("kept").groupBy("node").count().where("count > 1")
    if not repeated.isEmpty():
        place = F.row_number().over(W.partitionBy("node").orderBy("text"))
        left = left.withColumn("_place", place).where("_place = 1")
    return left.select(
        *(c if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in docs.columns)
    )
