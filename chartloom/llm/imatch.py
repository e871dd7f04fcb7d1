"""I-Match fingerprints: hashes of the sorted distinct terms of a text that lie in a band of inverse
document frequencies, one hash for each of several randomised subsets of the lexicon.

Terms are runs of letters and digits, lower case in ASCII. Document frequencies are counted over all
documents. The band leaves out terms in more than ``COMMON`` and in fewer than ``RARE`` of the documents
(and those in one document alone): shares, so a term's place does not change with the size of the table.
Frequencies sum to documents * mean distinct terms of one, so at most mean / ``RARE`` terms lie in the
band, whatever the collection: that is the bound of what is broadcast.

Each subset takes every lexicon term by a hash of term and subset, with a chance of 1/4, 1/16, 1/64
or 1/256, so that texts of any length have subsets with a few of their terms. The likeness of two
fingerprints is the share of equal hashes among the subsets that either text has a term in, which
estimates how much of their terms they share. Texts that no subset has a term of, as those of a rare
language or a few words, have subsets of all their terms instead; if these are empty as well, a hash of all
their terms, or of their bytes if they have none.

Nulls: a null text is an empty one; a null doc_id comes before all others. Rows with equal doc_id are
ordered by text. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from chartloom.llm import text as T
from chartloom.session import materialize

COMMON = 0.2
RARE = 0.002
#: Chance of a term to be in a subset, for each subset.
CHANCES = [1 / 4] * 2 + [1 / 16] * 6 + [1 / 64] * 12 + [1 / 256] * 12
NONE = "-" * 8
COUNT_BYTES = 16 << 20


def _terms(words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each text: text number and term, sorted by both."""
    hashes, text = words.hashes(lower_ascii=True), words.of_text()
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return text[fresh], hashes[fresh]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n) of each slice; a row without a term counts the documents."""
    for batch in T.slices(batches, size=COUNT_BYTES):
        found: list[np.ndarray] = []
        for small in T.slices(iter([batch])):
            found.append(_terms(T.words_of(small, kind=T.TERM))[1])
        term, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *term.view(np.int64).tolist()], pa.int64()),
                pa.array([batch.num_rows, *n.tolist()], pa.int64()),
            ],
            names=["term", "n"],
        )


def lexicon(docs: DataFrame) -> np.ndarray:
    """The sorted terms in the band."""
    counted = docs.select("text").mapInArrow(_count, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("df")
    )
    counted = materialize(counted, "frequencies")
    n_docs = counted.where(F.col("term").isNull()).agg(F.sum("df")).first()[0]
    if not n_docs:
        return np.zeros(0, np.uint64)
    low, high = max(2, RARE * n_docs), COMMON * n_docs
    chosen = counted.where(F.col("term").isNotNull() & F.col("df").between(low, high)).select("term")
    terms = chosen.toArrow().column("term").to_numpy()
    return np.sort(terms.view(np.uint64))


def _members(terms: np.ndarray) -> np.ndarray:
    """Whether each term is in each subset."""
    seeds = T.mix(np.arange(1, len(CHANCES) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    drawn = T.mix(terms[:, None] ^ seeds[None, :]) >> np.uint64(11)
    return drawn < (np.array(CHANCES) * 2.0**53).astype(np.uint64)[None, :]


def _subsets(terms: np.ndarray, members: np.ndarray) -> tuple[list[str], bool]:
    """A hash of the terms in each subset, and whether any has one."""
    counts = members.sum(axis=0)
    hashes = [
        hashlib.blake2b(terms[members[:, k]].tobytes(), digest_size=4).hexdigest() if counts[k] else NONE
        for k in range(len(CHANCES))
    ]
    return hashes, bool(counts.any())


def fingerprints(texts: list[str], band: np.ndarray, members: np.ndarray) -> list[str]:
    """One string per text: eight hex digits for each subset, and eight more where the subsets are not of
    the band: of all terms, or of the text itself."""
    words = T.Words(*T.texts(pa.array(texts, pa.large_string())), T.TERM)
    text, term = _terms(words)
    if len(band):
        at = np.minimum(np.searchsorted(band, term), len(band) - 1)
        inside = band[at] == term
    else:
        at, inside = np.zeros(len(term), np.int64), np.zeros(len(term), bool)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        part = slice(edges[i], edges[i + 1])
        own = at[part][inside[part]]
        parts, some = _subsets(band[own], members[own])
        if not some:
            parts, some = _subsets(term[part], _members(term[part]))
            rest = b"all" if some else term[part].tobytes() or (texts[i] or "").encode()
            parts.append(hashlib.blake2b(rest, digest_size=4).hexdigest())
        out.append("".join(parts))
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets in which either text has a term."""
    if a == b:
        return 1.0
    size = len(NONE)
    pairs = [(a[i : i + size], b[i : i + size]) for i in range(0, len(CHANCES) * size, size)]
    used = [x == y for x, y in pairs if (x, y) != (NONE, NONE)]
    return sum(used) / len(used) if used else 0.0


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprint(band: np.ndarray):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = _members(band)
        ids: list = []
        texts: list[str] = []
        size, extra_seen, kind = 0, False, None

        def flush() -> pa.RecordBatch:
            """All held rows but the last, which waits for its successor."""
            nonlocal ids, texts, size
            changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            own = fingerprints(texts, band, members)
            new = fingerprints(changed, band, members)
            n = len(changed)
            columns = [
                pa.array(ids[:n], kind),
                pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array(own[:n], pa.string()),
                pa.array(new, pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, new, strict=False)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            ]
            ids, texts = ids[n:], texts[n:]
            size = len(texts[0])
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, extra, text in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "extra", "text")), strict=True
            ):
                if extra_seen:
                    continue
                extra_seen = extra
                ids.append(doc)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= T.SLICE_BYTES and len(texts) > 1:
                    yield flush()
        if len(texts) > 1:
            yield flush()

    return run


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text and extra: every range of ids in a partition of its own, sorted, followed by the
    first row of the next range (after the last: of the first) with ``extra`` set.

    The ranges come from the ids alone; one id per partition reaches the driver. Texts are moved once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("o"))
    firsts = (
        ids.repartitionByRange(parts, "o")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("o").alias("first"))
    )
    starts = np.sort(np.array([r["first"] for r in firsts.collect()], np.int64))

    @F.pandas_udf(st.ArrayType(st.IntegerType()))
    def ranges(o: pd.Series) -> pd.Series:
        values = o.to_numpy()
        at = np.searchsorted(starts, values, "right") - 1
        opens = starts[np.maximum(at, 0)] == values
        before = (at - 1) % max(1, len(starts))
        return pd.Series(
            [[a, b] if f else [a] for a, b, f in zip(at.tolist(), before.tolist(), opens.tolist(), strict=True)]
        )

    placed = docs.select("doc_id", "text", order.alias("o")).withColumn("ranges", ranges("o"))
    spread = placed.select("doc_id", "text", "o", F.posexplode("ranges").alias("extra", "range"))
    return (
        spread.repartitionById(max(1, len(starts)), F.col("range"))
        .sortWithinPartitions("extra", "o", "text")
        .select("doc_id", (F.col("extra") == 1).alias("extra"), F.col("text"))
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, digest of the edited text, both fingerprints and both likenesses."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    band = lexicon(docs)
    return in_ranges(docs.select("doc_id", "text")).mapInArrow(
        _fingerprint(band),
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
