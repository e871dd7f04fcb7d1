"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the smallest hash among its
runs of ``MINIMISER`` words, so equal windows have equal minimisers wherever they occur. Consecutive
windows of a text that share a minimiser form a super-k-mer, which travels as one packed string to
the bucket of that minimiser. In a bucket, windows are given ranks by sorting (ranks of 2, 4, ... 32
words, then of 32 + 18 that overlap), so that equal ranks mean equal words, not equal hashes.

1. Thin rows of all super-k-mers (minimiser, document, position) are counted. Minimisers seen in one
   document only cannot hold a repeat between documents and go no further.
2. The texts of the others are cut into packed strings and dealt by minimiser. A minimiser with more
   than ``BUCKET`` super-k-mers is dealt to several buckets by document. There every occurrence but
   the smallest document's is already known to be a repeat; only the latter are compared between
   buckets, by a digest of the window and one minimum per digest.
3. Stretches to remove are gathered per document and applied to the whole text.

A word goes if a window that covers it also starts in a document with a smaller doc_id, judged on
the input. Nulls: a null text has no words; a null doc_id counts as larger than any other, and rows
with it never take words from each other. Rows with equal doc_id never take words from each other,
whatever their texts. An empty table gives an empty result. Other columns are carried untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm import text as T
from chartloom.llm.prefilter import may_be_in
from chartloom.session import materialize

WINDOW = 50
MINIMISER = 8
#: Super-k-mers of one minimiser in one bucket, beyond which it is dealt to several.
BUCKET = 1_000
#: Windows in one super-k-mer; a text that repeats itself is cut after so many.
LONGEST = 64
#: Bytes of packed strings that are sorted at once, in whole buckets.
SORT_BYTES = 1 << 20

_LAST = (1 << 63) - 1


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    low, have = values, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def super_kmers(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word within the text, number of windows and minimiser of each super-k-mer."""
    starts = words.windows(WINDOW)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = words.windows(MINIMISER)
    short = np.full(len(words.starts), np.iinfo(np.uint64).max, np.uint64)
    short[at] = T.window_hashes(words.hashes(), at, MINIMISER)
    value = _smallest(short, WINDOW - MINIMISER + 1)[starts]
    text = words.of_text()[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
    run = np.cumsum(fresh) - 1
    place = np.arange(len(starts)) - np.flatnonzero(fresh)[run]
    fresh |= place % LONGEST == 0
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, len(starts)))
    return text[begin], starts[begin] - words.first[text[begin]], size, value[begin]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        text, start, size, value = super_kmers(T.words_of(batch))
        keys = batch.select(["doc", "version"]).take(pa.array(text))
        yield pa.RecordBatch.from_arrays(
            [
                *keys.columns,
                pa.array(value.view(np.int64)),
                pa.array(start, pa.int32()),
                pa.array(size, pa.int32()),
            ],
            names=["doc", "version", "minimiser", "start", "size"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed strings of a text's listed super-k-mers, as they stand in the text."""
    names = ["minimiser", "part", "split", "doc", "version", "start", "packed"]
    for batch in T.slices(batches):
        words = T.words_of(batch)
        raw = words.data.tobytes()
        rows: list[list] = [[] for _ in names]
        docs, versions, wanted = (
            batch.column(c).to_pylist() for c in ("doc", "version", "wanted")
        )
        for i, items in enumerate(wanted):
            for item in items:
                first = words.first[i] + item["start"]
                last = first + item["size"] + WINDOW - 2
                packed = raw[words.starts[first] : words.ends[last]]
                values = (item["minimiser"], item["part"], item["split"])
                for column, v in zip(rows, (*values, docs[i], versions[i], item["start"], packed), strict=True):
                    column.append(v)
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names
        )


def _rank(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def window_ranks(ids: np.ndarray) -> np.ndarray:
    """A number for each run of ``WINDOW`` ids; equal numbers, equal runs."""
    rank, have = ids.astype(np.int64), 1
    while have < WINDOW:
        step = min(have, WINDOW - have)
        if len(rank) <= step:
            return np.zeros(0, np.int64)
        rank = _rank(rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:])
        have += step
    return rank


def _repeats(table: pa.Table) -> pa.RecordBatch:
    """Stretches to remove, and the windows of split buckets that no smaller document here has."""
    words: list[bytes] = []
    lengths = []
    for packed in table.column("packed").to_pylist():
        own = packed.split()
        words += own
        lengths.append(len(own))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lengths = np.array(lengths, np.int64)
    ends = np.cumsum(lengths)
    string = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(ends[string] - np.arange(len(ids)) >= WINDOW)
    rank, string = window_ranks(ids)[at], string[at]
    doc = table.column("doc").to_numpy()[string]
    version = table.column("version").to_numpy()[string]
    start = table.column("start").to_numpy()[string] + at - (ends - lengths)[string]

    order = np.lexsort((doc, rank))
    fresh = np.ones(len(order), bool)
    fresh[1:] = rank[order][1:] != rank[order][:-1]
    low = np.empty(len(order), np.int64)
    low[order] = doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    gone = doc > low

    begin = gone.copy()
    begin[1:] &= ~(gone[:-1] & (string[1:] == string[:-1]))
    close = gone.copy()
    close[:-1] &= ~(gone[1:] & (string[1:] == string[:-1]))
    a, b = np.flatnonzero(begin), np.flatnonzero(close)
    split = table.column("split").to_numpy(zero_copy_only=False)[string]
    left = np.flatnonzero(~gone & split)
    digests = [
        hashlib.blake2b(b" ".join(words[i : i + WINDOW]), digest_size=16).digest()
        for i in at[left].tolist()
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([doc[a], doc[left]]), pa.int64()),
            pa.array(np.concatenate([version[a], version[left]]), pa.int64()),
            pa.array(np.concatenate([start[a], start[left]]), pa.int32()),
            pa.array(np.concatenate([start[b], start[left]]) + WINDOW, pa.int32()),
            pa.array([None] * len(a) + digests, pa.binary()),
        ],
        names=["doc", "version", "start", "stop", "digest"],
    )


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets, several at a time; rows come sorted by bucket."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in T.slices(batches, "packed"):
        keys = np.stack([batch.column("minimiser").to_numpy(), batch.column("part").to_numpy()], 1)
        if size >= SORT_BYTES:
            last = held[-1].slice(held[-1].num_rows - 1)
            before = np.array([last.column("minimiser")[0].as_py(), last.column("part")[0].as_py()])
            other = np.flatnonzero((keys != before).any(axis=1))
            if len(other):
                held.append(batch.slice(0, other[0]))
                yield _repeats(pa.Table.from_batches(held))
                batch, held, size = batch.slice(other[0]), [], 0
            # a bucket that goes on is bounded by BUCKET strings
        held.append(batch)
        size += batch.column("packed").nbytes
    if held:
        yield _repeats(pa.Table.from_batches(held))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with equal key are equal in id and text."""
    return docs.withColumns(
        {
            "doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)),
            "version": F.xxhash64("text"),
        }
    )


def _once(keyed: DataFrame) -> DataFrame:
    """One row per (doc, version); only keys that several rows have are grouped with their texts."""
    key = ["doc", "version"]
    again = materialize(keyed.groupBy(key).count().where("count > 1").select(key), "repeated")
    if again.isEmpty():
        return keyed
    one = keyed.join(again, key, "left_semi").groupBy(key).agg(F.first("text").alias("text"))
    return keyed.join(again, key, "left_anti").unionByName(one)


def stretches(docs: DataFrame) -> DataFrame:
    """(doc, version, gone): for each text that loses words, the stretches [start, stop) of word
    numbers, in no order and possibly overlapping. ``docs`` has doc, version and text. Repeated rows
    have the same stretches and are cut once, so that no bucket grows with them."""
    docs = _once(docs)
    thin = materialize(
        docs.mapInArrow(
            _thin, "doc long, version long, minimiser long, start int, size int"
        ),
        "super-kmers",
    )
    seen = thin.groupBy("minimiser").agg(
        F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")
    )
    shared = seen.where(F.col("low") < F.col("high")).select(
        "minimiser", F.ceil(F.col("n") / BUCKET).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("doc", "version"), F.col("parts")).cast("int")
    item = F.struct("minimiser", part.alias("part"), (F.col("parts") > 1).alias("split"), "start", "size")
    wanted = (
        thin.join(shared, "minimiser")
        .groupBy("doc", "version")
        .agg(F.collect_set(item).alias("wanted"))
    )
    packed = docs.join(wanted.hint("shuffle_hash"), ["doc", "version"]).mapInArrow(
        _cut,
        "minimiser long, part int, split boolean, doc long, version long, start int, packed binary",
    )
    found = materialize(
        packed.repartition("minimiser", "part")
        .sortWithinPartitions("minimiser", "part")
        .mapInArrow(_sort, "doc long, version long, start int, stop int, digest binary"),
        "repeats",
    )
    open_ = found.where(F.col("digest").isNotNull())
    low = open_.groupBy("digest").agg(F.min("doc").alias("low"))
    late = open_.join(low, "digest").where(F.col("doc") > F.col("low"))
    gone = found.where(F.col("digest").isNull()).drop("digest").unionByName(
        late.select("doc", "version", "start", "stop")
    )
    return gone.groupBy("doc", "version").agg(
        F.collect_set(F.struct("start", "stop")).alias("gone")
    )


def kept_words(text: str | None, gone: list[dict] | None) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were."""
    words = (text or "").encode().split()
    if not gone:
        return words, len(words)
    stays = bytearray(b"\x01" * len(words))
    for g in gone:
        stays[g["start"] : g["stop"]] = bytes(g["stop"] - g["start"])
    return [w for w, s in zip(words, stays, strict=True) if s], len(words)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        n_words, n_removed, digests = [], [], []
        rows = zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True)
        for text, gone in rows:
            kept, n = kept_words(text, gone)
            n_words.append(n)
            n_removed.append(n - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests)],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _joined(docs: DataFrame) -> DataFrame:
    """``docs`` with ``gone``. Only texts that may lose words are shuffled to meet their stretches."""
    keyed = _keyed(docs)
    key = F.xxhash64("doc", "version")
    gone = materialize(stretches(keyed.select("doc", "version", "text")).withColumn("key", key), "stretches")
    marked = may_be_in(keyed.withColumn("key", key), "key", gone, "touched")
    touched = marked.where("touched").drop("key", "touched").join(gone.drop("key"), ["doc", "version"], "left")
    kind = dict(gone.dtypes)["gone"]
    same = marked.where("NOT touched").drop("key", "touched").withColumn("gone", F.lit(None).cast(kind))
    return touched.unionByName(same)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _joined(docs.select("doc_id", "text")).select("doc_id", "text", "gone")
    return rows.mapInArrow(
        _report, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    )


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        texts, left = [], []
        rows = zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True)
        for text, gone in rows:
            kept, n = kept_words(text, gone) if gone else ([], 0)
            texts.append(b" ".join(kept).decode() if gone else text)
            left.append(not gone or bool(kept))
        at = batch.schema.get_field_index("text")
        batch = batch.set_column(at, "text", pa.array(texts, pa.string()))
        yield batch.drop_columns(["gone"]).filter(pa.array(left))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated words: a text that loses words becomes its kept words, joined
    by one space, with n_chars to match; other rows stay as they are. A text that loses all of its
    words goes."""
    inner = [c for c in docs.columns if c not in ("text", "doc_id")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0), *(f"`{c}`" for c in inner)).alias("rest"))
    rows = _joined(packed).select("doc_id", "text", "rest", "gone")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    short = rows.mapInArrow(
        _shorten, f"doc_id {kinds['doc_id']}, text string, rest {kinds['rest']}"
    )
    values = {c: F.col(f"rest.`{c}`") for c in inner} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in inner:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.coalesce(F.length("text").cast(kind), F.col("rest.n_chars"))
    return short.select(*(values[c].alias(c) for c in docs.columns))
