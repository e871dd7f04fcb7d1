"""Ranked search through bit-sliced Bloom signatures.

The index has a row for each block of documents of like size. A document's terms (runs of letters,
digits and characters beyond ASCII, A-Z as a-z) go into a Bloom signature, once for every level j
with tf >= 2**j. A block keeps its signatures sliced: row r of the bitmap has bit r of each of its
documents. The bits of a term's rows, ANDed, say which documents may hold the term so often, never
too few of them. With G(tf) the contribution of tf occurrences for a weight of 1,

    bound = sum over j of (G(2**(j + 1) - 1) - G(2**j - 1)) * sum of the weights of level j's terms

is then an upper bound of the score: one weighted sum of slices for each level and item, in whole
numbers. A document is left out for an item only where the bound is below the score of the task's
tenth best so far; all others are scored exactly, from the distinct terms and counts that the block
keeps beside the slices. The tasks' best meet in the end. Nothing but these and counts is shuffled.

Score: sum over the item's distinct terms of w * ((10**9 * tf) div (1000 * tf + 8 * m)) with
w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 10 + ((90 * n * N) div L).

Terms are told apart by 64 bits. Items are asked in blocks of some ``BLOCK_TERMS`` terms, so what
reaches driver and tasks has a bound; only an item with more terms than that has a block of its size.

Nulls: a null text has no terms; a document without terms is in no result and not in N, an item
without terms has no result. A null doc_id ranks after all others of the same score; a null item_id is
an id. Each row of the documents is a document, also if repeated. Items equal in id and text are one
item; two texts under one item_id are ranked apart. Without documents or items there is no result.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm import text as T
from chartloom.session import materialize

BEST = 10
#: Bits of a signature for each term and level in it, at least; rows that each of these sets.
BITS, ROWS = 8, 4
#: Documents of a block at most, and bits of its bitmap (a longer document is a block of its own).
DOCS, CELLS = 256, 1 << 23
BLOCK_TERMS = 200_000
#: Numbers in one step of a weighted sum.
STEP = 1 << 22
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def distinct_terms(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term and count of each text's distinct terms, text by text, and where each text begins."""
    of, hashes = words.of_text(), words.hashes(lower_ascii=True)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    starts = np.searchsorted(of[at], np.arange(len(words.counts) + 1))
    return hashes[at], np.diff(np.append(at, len(of))), starts


def places(terms: np.ndarray, level: int, width: int) -> np.ndarray:
    """Rows of a bitmap of ``width`` rows that each term sets at a level."""
    drawn = T.mix(terms + np.array([level + 1], np.uint64) * _GOLD)
    step = (drawn >> np.uint64(32)) | np.uint64(1)
    return (drawn[:, None] + np.arange(ROWS, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Levels that each count reaches."""
    return np.frexp(counts.astype(float))[1]


def width_of(counts: np.ndarray) -> int:
    """Rows for a document with these counts, a power of two."""
    return 1 << max(6, int(BITS * levels_of(counts).sum() - 1).bit_length())


def slices_of(terms: np.ndarray, counts: np.ndarray, owner: np.ndarray, docs: int, width: int) -> np.ndarray:
    """The bitmap, bit by bit of a row a document; ``owner`` is the document of each term."""
    cells = np.zeros((width, docs), bool)
    reached = levels_of(counts)
    for level in range(int(reached.max())):
        in_it = reached > level
        cells[places(terms[in_it], level, width), owner[in_it, None]] = True
    return np.packbits(cells, axis=1)


def _block(width: int, held: list[tuple]) -> pa.RecordBatch:
    """One row of the index of documents (id, n, terms, counts)."""
    sizes = [len(d[2]) for d in held]
    terms, counts = np.concatenate([d[2] for d in held]), np.concatenate([d[3] for d in held])
    cells = slices_of(terms, counts, np.repeat(np.arange(len(held)), sizes), len(held), width)
    n = [int(d[1]) for d in held]
    row = {
        "n_docs": pa.array([len(held)], pa.int64()),
        "n_terms": pa.array([sum(n)], pa.int64()),
        "width": pa.array([width], pa.int64()),
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.concat_arrays([d[0] for d in held])),
        "n": pa.array([n], pa.list_(pa.int64())),
        "top": pa.array([[int(d[3].max()) for d in held]], pa.list_(pa.int64())),
        "slices": pa.array([cells.tobytes()], pa.binary()),
        "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "terms": pa.array([terms.tobytes()], pa.binary()),
        "counts": pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(row)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (doc_id, text): documents of one width together, those that fill a block at once."""
    waiting: dict[int, list[tuple]] = defaultdict(list)
    for batch in T.slices(batches):
        words = T.words_of(batch, kind=T.TERM)
        terms, counts, starts = distinct_terms(words)
        for i in np.flatnonzero(words.counts):
            own, often = terms[starts[i] : starts[i + 1]], counts[starts[i] : starts[i + 1]]
            width = width_of(often)
            held = waiting[width]
            held.append((batch.column("doc_id").slice(i, 1), words.counts[i], own.copy(), often.copy()))
            if len(held) >= min(DOCS, CELLS // width):
                yield _block(width, waiting.pop(width))
    for width, held in waiting.items():
        yield _block(width, held)


def build(docs: DataFrame) -> DataFrame:
    """The index of all documents, stored. It knows nothing of what will be asked."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"n_docs long, n_terms long, width long, doc_ids array<{kind}>, n array<bigint>, top array<bigint>, "
        "slices binary, sizes array<bigint>, terms binary, counts binary"
    )
    return materialize(docs.select("doc_id", "text").mapInArrow(_blocks, schema), "bitslices")


class Asked:
    """The terms of a block of items: ``terms`` sorted and distinct; for each item and distinct term
    in it an occurrence, item by item: ``term`` and ``item``."""

    def __init__(self, lists: list[np.ndarray]):
        every = np.concatenate([*lists, np.zeros(0, np.uint64)])
        self.terms, term = np.unique(every, return_inverse=True)
        self.item = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.term = term
        self.n_items = len(lists)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where asked terms stand in ``terms``, and which they are."""
        at = np.flatnonzero(self.seen[(terms & np.uint64((1 << 20) - 1)).astype(np.int64)])
        which = np.searchsorted(self.terms, terms[at])
        which[which == len(self.terms)] = 0
        right = self.terms[which] == terms[at] if len(self.terms) else np.zeros(0, bool)
        return at[right], which[right]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, terms, n) of (item_id, text)."""
    for batch in T.slices(batches):
        terms, _, starts = distinct_terms(T.words_of(batch, kind=T.TERM))
        own = [terms[starts[i] : starts[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(own, pa.binary()), pa.array(np.diff(starts), pa.int64())],
            names=["item_id", "terms", "n"],
        )


def _frequencies(asked: Asked) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(asked.terms), np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                _, which = asked.found(np.frombuffer(terms.as_buffer(), np.uint64))
                df += np.bincount(which, minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some])], names=["term", "df"])

    return count


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Contribution of ``tf`` occurrences for a weight of 1."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Scorer:
    """Best documents of each item among the blocks it is given."""

    def __init__(self, asked: Asked, weight: np.ndarray, n_docs: int, n_terms: int, best: int):
        self.asked, self.weight, self.best = asked, weight, best
        self.n_docs, self.n_terms = n_docs, n_terms
        use = weight[asked.term] > 0
        self.term, self.item = asked.term[use], asked.item[use]
        self.by_term = np.argsort(self.term, kind="stable")
        self.first = np.searchsorted(self.term[self.by_term], np.arange(len(weight) + 1))
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        self.top: dict[int, list[tuple]] = defaultdict(list)
        self.least = np.ones(asked.n_items, np.int64)
        self.scored = 0

    def bounds(self, width: int, cells: np.ndarray, top: np.ndarray, m: np.ndarray) -> np.ndarray:
        """No score of (item, document) is above this."""
        docs = len(top)
        out = np.zeros((self.asked.n_items, docs), np.int64)
        live, before = np.flatnonzero(self.weight > 0), None
        for level in range(int(top.max()).bit_length()):
            if (width, level) not in self.rows:
                self.rows[width, level] = places(self.asked.terms, level, width).astype(np.int64)
            have = np.bitwise_and.reduce(cells[self.rows[width, level][live]], axis=1)
            if before is not None:
                have &= before
            some = have.any(axis=1)
            live, before = live[some], have[some]
            if not len(live):
                break
            step = gain(np.minimum((2 << level) - 1, top), m) - gain(np.minimum((1 << level) - 1, top), m)
            where = np.full(len(self.weight), -1)
            where[live] = np.arange(len(live))
            use = np.flatnonzero(where[self.term] >= 0)
            self._add(out, use, where[self.term[use]], before, step)
        return out

    def _add(self, out, use, row, have, step) -> None:
        """Weighted sums of slices, some occurrences at a time."""
        docs = out.shape[1]
        for a in range(0, len(use), max(1, STEP // docs)):
            part = slice(a, a + max(1, STEP // docs))
            bits = np.unpackbits(have[row[part]], axis=1, count=docs)
            item = self.item[use[part]]
            begins = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
            weighted = bits * self.weight[self.term[use[part]], None]
            out[item[begins]] += np.add.reduceat(weighted, begins, axis=0) * step

    def exact(self, docs: np.ndarray, m: np.ndarray, sizes, terms, counts) -> np.ndarray:
        """Scores of all items for some documents of a block."""
        ends = np.cumsum(sizes)
        own = np.concatenate([np.arange(ends[d] - sizes[d], ends[d]) for d in docs])
        at, which = self.asked.found(terms[own])
        doc = np.repeat(np.arange(len(docs)), sizes[docs])[at]
        value = gain(counts[own[at]].astype(np.int64), m[docs][doc]) * self.weight[which]
        times = self.first[which + 1] - self.first[which]
        each = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        item = self.item[self.by_term[np.repeat(self.first[which], times) + nth]]
        out = np.zeros((self.asked.n_items, len(docs)), np.int64)
        np.add.at(out, (item, doc[each]), value[each])
        return out

    def take(self, block: dict) -> None:
        ids, width, n, top, sizes = (block[c] for c in ("doc_ids", "width", "n", "top", "sizes"))
        m = 10 + _product_div(90 * self.n_docs, n, self.n_terms)
        cells = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
        may = self.bounds(width, cells, top, m) >= self.least[:, None]
        docs = np.flatnonzero(may.any(axis=0))
        if not len(docs):
            return
        terms, counts = np.frombuffer(block["terms"], np.uint64), np.frombuffer(block["counts"], np.int32)
        scores = self.exact(docs, m, sizes, terms, counts)
        self.scored += int(may.sum())
        good = (scores >= self.least[:, None]) & may[:, docs]
        for item in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[item])
            if len(at) > self.best:  # those that tie with the last one stay, the id decides
                last = -np.partition(-scores[item, at], self.best - 1)[self.best - 1]
                at = at[scores[item, at] >= last]
            rows = [(-int(scores[item, d]), *_rank(ids[int(docs[d])])) for d in at]
            self.top[item] = sorted([*self.top[item], *rows])[: self.best]
            if len(self.top[item]) == self.best:
                self.least[item] = -self.top[item][-1][0]


def _rank(doc_id) -> tuple:
    """Null ids last."""
    doc = doc_id.as_py()
    return (1, 0) if doc is None else (0, doc)


def _product_div(factor: int, n: np.ndarray, by: int) -> np.ndarray:
    """(factor * n) div by, also where the product has more than 63 bits."""
    if factor * int(n.max()) < 1 << 63:
        return (factor * n) // by
    return np.array([factor * int(x) // by for x in n], np.int64)


def _search(asked: Asked, weight: np.ndarray, n_docs: int, n_terms: int, best: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(asked, weight, n_docs, n_terms, best)
        kind = pa.null()
        for batch in batches:
            for i in range(batch.num_rows):
                block = {c: batch.column(c)[i] for c in batch.schema.names}
                kind = block["doc_ids"].values.type
                scorer.take(
                    {c: block[c].values.to_numpy(False) for c in ("n", "top", "sizes")}
                    | {c: block[c].as_buffer() for c in ("slices", "terms", "counts")}
                    | {"width": block["width"].as_py(), "doc_ids": block["doc_ids"].values}
                )
        rows = [(item, None if r[1] else r[2], -r[0]) for item, top in scorer.top.items() for r in top]
        if not rows:
            return
        columns, kinds = zip(*rows, strict=True), (pa.int64(), kind, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "doc_id", "score"]
        )

    return search


def _weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))); 0 for a term that no document has."""
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df]
    return np.array(w, np.int64)


def search(index: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of ``index`` for each of ``items``
    (item_id, text)."""
    spark = index.sparkSession
    kinds = [items.schema["item_id"].dataType.simpleString(), index.schema["doc_ids"].dataType.elementType.simpleString()]
    asked_for = items.select("item_id", "text").distinct()
    asked_for = materialize(
        asked_for.mapInArrow(_item_terms, f"item_id {kinds[0]}, terms binary, n long").where("n > 0"), "items"
    )
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    total = asked_for.agg(F.sum("n")).first()[0]
    found = []
    blocks = -(-total // BLOCK_TERMS) if total and n_docs else 0
    block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks))
    for number in range(blocks):
        part = asked_for.where(block == number).toArrow()
        if not part.num_rows:
            continue
        asked = Asked([np.frombuffer(t.as_buffer(), np.uint64) for t in part.column("terms")])
        counted = index.select("terms").mapInArrow(_frequencies(asked), "term long, df long")
        df = np.zeros(len(asked.terms), np.int64)
        for row in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
            df[row.term] = row.df
        run = _search(asked, _weights(df, n_docs), n_docs, n_terms, best)
        ranked = index.select("doc_ids", "width", "n", "top", "slices", "sizes", "terms", "counts").mapInArrow(
            run, f"item long, doc_id {kinds[1]}, score long"
        )
        place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = ranked.withColumn("rank", place).where(F.col("rank") <= best)
        names = spark.createDataFrame(
            pa.table({"item": pa.array(range(part.num_rows), pa.int64()), "item_id": part.column("item_id")}),
        ).select("item", F.col("item_id").cast(kinds[0]))
        found.append(materialize(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not found:
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``search`` over an index of ``docs`` made for it."""
    return search(build(docs), items, best)
