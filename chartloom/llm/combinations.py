"""Similarity join of documents by token-combination prefixes.

A document's set holds its distinct windows of three words (A-Z as a-z; fewer words are one element).
Two documents link where 100 * common elements >= 90 * elements of both; what links reach is a component.
Equal sets become one node first, so copies are not expanded into pairs.

Two sieves take away nodes that link with nothing. A node may lack at most a tenth of its elements, e, in
a partner, so of any elements chosen by their hash alone all but e must occur in another node. The
first sieve asks this of the fifth of the elements with the lowest hashes, of all texts; the second of
all elements of the texts left, twice. Both only leave out nodes that cannot link.

The elements left are put in one order, rare ones first. Element classes by frequency say how many
tokens a signature combines: one of the rare, two or three of the frequent. Two nodes without a common
signature have k - 1 common elements in each group of a class of k at most. So a prefix of a node is
extended until its elements, less k - 1 for each group in it, are more than e: two nodes that link have
a signature in common in theirs (the shorter prefix's common elements lie in the other as well). Groups
divide a class by hash, more of them for larger sets, so that the number of combinations grows
with the prefix and not with its square; sizes are bracketed by powers of two for that, and a node
near the end of a bracket signs in the next as well.

Members of a signature are compared with the one of them that lacks least; what is then still in different
components is compared in full, where it can link by size, by the elements it shares with any set, and
by a bitmap that says of how many elements, at least, two sets differ. None of these leaves out a pair
that links. Of two sets the one that is not larger has the signature in a shorter prefix, as it must
have more in common with the other. Comparing is exact, on whole sets. Shingles are told apart by 64 bits.

Nulls: a null text has no elements and links with nothing, like a text without words; its component is
its own id. A null doc_id is carried and names no component that has another id. Repeated rows are
equal sets. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations as choose

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm import text as T
from chartloom.llm.components import components
from chartloom.llm.prefilter import may_be_in
from chartloom.session import materialize

SHINGLE = 3
#: Least share of common elements, in hundredths. With 90, a tenth of a set may be missing in a partner.
SIMILARITY = 90
#: Share of the elements that the first sieve looks at; more than may be missing.
SAMPLE = 0.2
#: Greatest frequency of a class, and how many of its tokens a signature combines.
CLASSES = ((32, 1), (4096, 2), (1 << 62, 3))
#: Elements of a set for each group of a class; sets of fewer than ``SINGLE`` have single tokens only.
GROUP, SINGLE = 32, 16
#: Bits of the parity bitmaps that tell sets apart before they are compared.
PARITY_BITS = 512
_GOLD = 0x9E3779B97F4A7C15
#: In the sieves two elements may pass for one, that only keeps more.
_SHORT = np.uint64((1 << 48) - 1)


def shingles(words: T.Words, hashes: np.ndarray, i: int) -> np.ndarray:
    """Distinct elements of text ``i``, sorted."""
    own = hashes[words.first[i] : words.first[i + 1]]
    if not len(own):
        return np.zeros(0, np.uint64)
    size = min(SHINGLE, len(own))
    return np.unique(T.window_hashes(own, np.arange(len(own) - size + 1), size))


def may_lack(n):
    """How many of ``n`` elements may be missing in a partner."""
    return n - -(-n * SIMILARITY // 100)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in T.slices(batches):
        words = T.words_of(batch)
        hashes = words.hashes(lower_ascii=True)
        yield batch, [shingles(words, hashes, i) for i in range(batch.num_rows)]


def _node(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, node, short, n, need, sample): need elements of the sample must occur elsewhere."""
    limit = np.uint64(int(SAMPLE * 2**64))
    for batch, sets in _sets(batches):
        nodes = [_node(s) for s in sets]
        samples = [(s[: np.searchsorted(s, limit)] & _SHORT).astype(np.int64) for s in sets]
        need = [len(x) - may_lack(len(s)) for x, s in zip(samples, sets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(nodes, pa.binary()),
                pa.array([int.from_bytes(x[:6], "little") for x in nodes], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(need, pa.int64()),
                pa.array(samples, pa.list_(pa.int64())),
            ],
            names=["doc_id", "node", "short", "n", "need", "sample"],
        )


def _noded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, sets in _sets(batches):
        nodes = pa.array([_node(s) for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=[*batch.schema.names, "node"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(num, elements) of (num, text)."""
    for batch, sets in _sets(batches):
        lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("num"), lists], names=["num", "elements"])


def _alive(rows: DataFrame) -> DataFrame:
    """Nodes that the first sieve leaves. Counted row by row, so that no copy need be known."""
    sampled = rows.select("key", "short", F.explode("sample").alias("token"))
    shared = sampled.groupBy("token").agg(F.min("short").alias("low"), F.max("short").alias("high"))
    shared = materialize(shared.where("low < high").select("token"), "shared")
    held = sampled.select("key", "token").join(shared, "token", "left_semi")
    held = held.groupBy("key").agg(F.count("*").alias("held"))
    left = rows.where("n > 0").select("key", "node", "need").join(held, "key", "left")
    return left.where(F.col("need") <= F.coalesce("held", F.lit(0))).select("node").distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(num, text): one text of each wanted node, from a row with the node's smallest id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    noded = docs.select("doc_id", "text").mapInArrow(_noded, f"doc_id {kind}, text string, node binary")
    noded = may_be_in(noded, "node", wanted, "_wanted").where("_wanted").drop("_wanted")
    w = wanted.select(F.col("node").alias("w"), "owner", "num")
    same = (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("owner"))
    return noded.join(w, same).groupBy("num").agg(F.first("text").alias("text"))


def _sieve(sets: DataFrame, *of_element: str) -> DataFrame:
    """(num, n, found) of the ``sets`` (num, n, elements) whose elements but the few that may be missing
    occur in another set; ``found``: these elements, and how many sets have them if that is asked for."""
    flat = sets.select("num", F.explode("elements").alias("element"))
    common = materialize(flat.groupBy("element").agg(F.count("*").alias("df")).where("df > 1"), "common")
    wanted = F.struct(*of_element) if of_element else F.col("element")
    found = flat.join(common, "element").groupBy("num").agg(F.collect_list(wanted).alias("found"))
    least = F.ceil(F.col("n") * SIMILARITY / 100)
    return sets.select("num", "n").join(found, "num").where(F.size("found") >= least)


def brackets(n: int) -> list[int]:
    """The brackets of the sizes that a partner of at least ``n`` elements can have."""
    return sorted({n.bit_length() - 1, (n * 100 // SIMILARITY).bit_length() - 1})


def groups(elements: np.ndarray, df: np.ndarray, bracket: int, classes=CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in a signature of each element, and its group; a rare element is in no group."""
    if 1 << bracket < SINGLE:
        return np.ones(len(df), np.int64), np.zeros(len(df), np.int64)
    kind = np.searchsorted([most for most, _ in classes], df)
    k = np.array([size for _, size in classes])[kind]
    parts = max(1, (1 << bracket) // GROUP)
    return k, kind * parts + (T.mix(elements) % np.uint64(parts)).astype(np.int64)


def prefix(k: np.ndarray, group: np.ndarray, need: int) -> int:
    """How many elements, in order, it takes until more than ``need`` - 1 of them cannot be missing
    without a common signature: in a group of k the first k - 1 do not count."""
    order = np.argsort(group, kind="stable")
    begins = np.searchsorted(group[order], group[order])
    nth = np.empty(len(group), np.int64)
    nth[order] = np.arange(len(group)) - begins
    counted = np.cumsum(nth >= k - 1)
    return min(len(k), int(np.searchsorted(counted, need)) + 1)


def least_common(n: int, larger: bool) -> int:
    """How many of its ``n`` elements a set has in common with any partner it links with, at least; more
    if the partner is not smaller."""
    return -(-n * 2 * SIMILARITY // (100 + SIMILARITY)) if larger else -(-n * SIMILARITY // 100)


def signatures(elements: np.ndarray, df: np.ndarray, n: int, classes=CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set of ``n`` elements, of which ``elements`` occur in ``df`` sets each, several,
    and which of them meet partners that are not smaller: the prefix for these is shorter.

    Elements of one set alone come first in the order; if they are too many, there is no signature.
    """
    unique = n - len(elements)
    need, short_need = (n - least_common(n, larger) + 1 - unique for larger in (False, True))
    if need <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    order = np.lexsort((elements, df))
    elements, df = elements[order], df[order]
    made, short = [], []
    for bracket in brackets(n):
        k, group = groups(elements, df, bracket, classes)
        to = prefix(k, group, need)
        short_to = prefix(k, group, short_need) if short_need > 0 else 0
        salt = np.uint64((bracket + 1) * _GOLD & 0xFFFFFFFFFFFFFFFF)
        own = T.mix(elements[:to] ^ salt)
        for g in np.unique(group[:to]):
            at = np.flatnonzero(group[:to] == g)
            size = int(k[at[0]])
            if len(at) < size:
                continue
            chosen = np.array(list(choose(at.tolist(), size)), np.int64)
            value = np.zeros(len(chosen), np.uint64)
            for column in chosen.T:
                value = T.mix((value ^ own[column]) * np.uint64(_GOLD))
            made.append(value)
            short.append(chosen[:, -1] < short_to)
    made, short = np.concatenate(made), np.concatenate(short)
    order = np.lexsort((~short, made))
    first = np.append(True, made[order][1:] != made[order][:-1])
    return made[order][first], short[order][first]


def parity(elements: np.ndarray) -> np.ndarray:
    """Of each of ``PARITY_BITS`` bits whether an odd number of elements falls on it. Two sets' bits differ
    in no more places than their elements do."""
    fallen = np.bincount((T.mix(elements ^ np.uint64(_GOLD)) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((fallen & 1).astype(bool)).view(np.int64)


def _signed(classes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(signature, short, num, n, common, bits) of (num, n, found)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            df, elements = (found.values.field(c).to_numpy(False) for c in ("df", "element"))
            ends = found.offsets.to_numpy()
            for i in range(batch.num_rows):
                own = slice(ends[i], ends[i + 1])
                num, n = (batch.column(c)[i].as_py() for c in ("num", "n"))
                keys = elements[own].view(np.uint64)
                made, short = signatures(keys, df[own], n, classes)
                fixed = (np.full(len(made), x, np.int64) for x in (num, n, len(keys)))
                bits = pa.array([parity(keys)] * len(made), pa.list_(pa.int64()))
                columns = [pa.array(made.view(np.int64)), pa.array(short), *(pa.array(x) for x in fixed), bits]
                yield pa.RecordBatch.from_arrays(columns, names=["signature", "short", "num", "n", "common", "bits"])

    return sign


def _can_link() -> Column:
    """Whether two sizes, the elements that each shares with any set and the bits that differ allow
    enough common ones."""
    differing = sum(F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("p_bits", F.lit(i)))) for i in range(PARITY_BITS // 64))
    most = F.least(F.col("common"), F.col("p_common"), F.floor((F.col("common") + F.col("p_common") - differing) / 2))
    return F.lit(100) * most >= F.lit(SIMILARITY) * (F.col("n") + F.col("p_n") - most)


def _met(members: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs (a, b) of a signature in different components that can link, smaller number first. The one
    that is not larger has the signature in its shorter prefix."""
    p = others.select("signature", *(F.col(c).alias(f"p_{c}") for c in ("num", "n", "short", "common", "bits", "label")))
    short = (F.col("short") & (F.col("n") <= F.col("p_n"))) | (F.col("p_short") & (F.col("p_n") <= F.col("n")))
    joined = members.join(p, "signature").where(
        (F.col("label") != F.col("p_label")) & short & _can_link()
    )
    return joined.select(
        F.least("num", "p_num").alias("a"), F.greatest("num", "p_num").alias("b")
    ).distinct()


def _pivots(members: DataFrame) -> DataFrame:
    """Of each signature the member with the fewest elements that no other set has."""
    first = F.struct(F.col("n") - F.col("common"), "num", "n", "short", "common", "bits", "label")
    return members.groupBy("signature").agg(F.min(first).alias("p")).select("signature", "p.*")


def _unsettled(members: DataFrame) -> DataFrame:
    """Members of signatures that several components have, with the one most members are in."""
    parts = members.groupBy("signature", "label").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("signature").agg(
        F.max(F.struct("c", "label"))["label"].alias("main"), F.count("*").alias("parts")
    )
    return members.join(mixed.where("parts > 1"), "signature")


def _links(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets."""
    a, b = (sets.select(F.col("num").alias(x), F.col("n").alias(f"n_{x}"), F.col("elements").alias(f"of_{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("of_a", "of_b")))
    return both.where(
        100 * F.col("both") >= SIMILARITY * (F.col("n_a") + F.col("n_b") - F.col("both"))
    ).select("a", "b")


def _merge(sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(num, label) of sets that link with others, and the links found on the way."""
    signed = sets.select("num", "n", "found").mapInArrow(_signed(CLASSES), "signature long, short boolean, num long, n long, common long, bits array<bigint>")
    signed = materialize(signed, "signed")
    several = signed.groupBy("signature").agg(F.count("*").alias("c")).where("c > 1").select("signature")
    members = materialize(signed.join(several, "signature").withColumn("label", F.col("num")), "members")
    whole = sets.select("num", "n", F.col("found.element").alias("elements"))
    links = None
    for number in range(2):
        if number == 0:
            pairs = _met(members, _pivots(members))
        else:
            left = materialize(_unsettled(members), "unsettled")
            pairs = _met(left.where("label != main"), left)
        pairs = materialize(pairs, "pairs")
        if pairs.isEmpty():
            continue
        new = materialize(_links(whole, pairs), "links")
        links = new if links is None else links.unionByName(new)
        merged = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        merged = merged.select(F.col("node").alias("num"), F.col("label").alias("to"))
        if number == 0:
            members = members.join(merged, "num", "left").withColumn("label", F.coalesce("to", "label")).drop("to")
            members = materialize(members, "members")
    return (None, None) if links is None else (merged, links)


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach, the row's own included) and n_links
    (links between different sets that were verified for this one) for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(
        _rows, f"doc_id {kind}, node binary, short long, n long, need long, sample array<bigint>"
    )
    rows = materialize(rows.withColumn("key", F.monotonically_increasing_id()), "rows")
    owners = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("owner"), F.first("n").alias("n"))
    wanted = owners.join(_alive(rows), "node").withColumn("num", F.monotonically_increasing_id())
    wanted = materialize(wanted, "wanted")
    own = _texts(docs, wanted).mapInArrow(_elements, "num long, elements array<bigint>")
    sets = materialize(own.withColumn("n", F.size("elements").cast("long")), "sets")
    sets = materialize(_sieve(sets), "sieved").withColumnRenamed("found", "elements")
    sets = materialize(_sieve(sets, "df", "element"), "sieved")
    merged, links = _merge(sets)
    if merged is None:
        named = owners.select("node", F.col("owner").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    else:
        ends = links.select(F.explode(F.array("a", "b")).alias("num")).groupBy("num")
        linked = ends.agg(F.count("*").alias("n_links")).join(merged, "num", "left")
        linked = wanted.join(linked, "num").withColumn("label", F.coalesce("to", "num"))
        linked = materialize(linked.select("node", "owner", "label", "n_links"), "linked")
        least = linked.groupBy("label").agg(F.min("owner").alias("least"))
        linked = linked.join(least, "label").select("node", "least", "n_links")
        named = owners.select("node", "owner").join(linked, "node", "left").select(
            "node",
            F.coalesce("least", "owner").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    named = materialize(named, "named")
    return rows.select("doc_id", "node", F.col("n").alias("n_shingles")).join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
