"""Toxicity by a convolutional text classifier, trained on every labelled text.

Terms (runs of letters and digits, lower case in ASCII) are embedded by hashing: a term's vector is
the sum of three rows of one table, for the term and for its first four and first five bytes. Filters
of widths 1, 2 and 3 run over the whole text, their largest value over the text is kept, and a linear
layer gives the logit. The first columns of the table start from how much more often a bucket occurs
in toxic than in other texts, in standard deviations; everything is then trained by gradient descent,
with gradients through the places of the maxima.

All labelled texts outside the held-out third are learned from, whatever their number and length. They
are dealt by a hash to shards of some ``SHARD_BYTES``. In each epoch every shard descends from the same
model over its own texts, and the model moves by the mean of what the shards did to each parameter; a row
of the table by the mean over the shards that touched it. Moves are summed as whole numbers, so neither
partitions nor the order of the sums change the model. A quarter of the texts is kept from training to
calibrate: for each language with enough toxic texts there, the logit that separates best becomes score
0.7; logits are counted in steps of 1 / ``STEPS`` for that. The language of a scored text is told from its
words, by frequencies in the texts trained on; labels, language and source columns and ids are never read
when scoring.

Nulls: a null text is empty; a text without a term scores as one whose filters find nothing. Labels
with null toxic are not used, nor are labels of a null text. Repeated rows score alike, and are learned
from as one row with their number; an empty table gives an empty result, and
without labels of both classes every score is 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm import prefilter
from chartloom.llm import text as T
from chartloom.session import materialize

#: Bounds of ``sample``; nothing is learned from it.
PER_CLASS = 5_000
SAMPLE_CHARS = 40_000
THRESHOLD = 0.7
BUCKETS = 1 << 18
LANG_BUCKETS = 1 << 14
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
EPOCHS = 5
BATCH = 64
RATE = 0.05
#: Toxic texts of a language among those kept for calibration, below which the common logit holds.
LANG_LEAST = 25
SLICE = 1 << 20
#: Words whose filter values a task holds at once when it learns, if no text has more.
SLICE_WORDS = 1 << 16
#: Bytes of labelled texts in a shard, on average, and the most partitions for the shards.
SHARD_BYTES = 16 << 20
SHARD_TASKS = 4096
#: Steps of a logit, and the largest, when logits are counted for calibration.
STEPS = 1024
FAR = 64
#: Moves of parameters are summed as multiples of its inverse.
FIXED = float(1 << 32)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


@dataclass
class Model:
    table: np.ndarray
    kernel: np.ndarray  # DIM x all filters of all places of all widths
    bias: np.ndarray
    out: np.ndarray
    shift: float
    langs: np.ndarray = field(default_factory=lambda: np.zeros((LANG_BUCKETS, 0), np.float32))
    logits: np.ndarray = field(default_factory=lambda: np.zeros(1))
    scale: float = 1.0


@dataclass
class Features:
    rows: np.ndarray  # n x 3 buckets
    first: np.ndarray  # of each text, and the end
    langs: np.ndarray  # bucket of each term for the language


def _prefix(words: T.Words, length: int) -> np.ndarray:
    """Hash of the first ``length`` bytes of each word."""
    ends = np.minimum(words.ends, words.starts + length)
    value = np.zeros(len(words.starts), np.uint64)
    for i in range(length):
        at = np.minimum(words.starts + i, len(words.data) - 1)
        byte = words.data[at].astype(np.uint64)
        byte = np.where((byte >= 65) & (byte <= 90), byte + np.uint64(32), byte)
        value = value * np.uint64(257) + np.where(words.starts + i < ends, byte + np.uint64(1), np.uint64(0))
    return T.mix(value + np.uint64(length))


def features(words: T.Words) -> Features:
    if not len(words.starts):
        return Features(np.zeros((0, 3), np.int32), words.first, np.zeros(0, np.int32))
    whole = words.hashes(lower_ascii=True)
    parts = [whole, _prefix(words, 4), _prefix(words, 5)]
    rows = np.stack([(p % np.uint64(BUCKETS)).astype(np.int32) for p in parts], 1)
    return Features(rows, words.first, ((whole >> np.uint64(40)) % np.uint64(LANG_BUCKETS)).astype(np.int32))


def _columns(width: int) -> tuple[int, int]:
    """Columns of the kernel that belong to a width."""
    before = sum(w for w in WIDTHS if w < width) * FILTERS
    return before, before + width * FILTERS


def _pool(model: Model, f: Features) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The largest filter values of each text (0 at least), all filter values, and embeddings."""
    n = len(f.first) - 1
    pooled = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
    if not len(f.rows):
        return pooled, [], np.zeros((0, DIM), np.float32)
    vectors = model.table[f.rows[:, 0]] + model.table[f.rows[:, 1]] + model.table[f.rows[:, 2]]
    products = vectors @ model.kernel
    text = np.repeat(np.arange(n), np.diff(f.first))
    some = np.flatnonzero(np.diff(f.first))
    values = []
    for k, width in enumerate(WIDTHS):
        a, _ = _columns(width)
        value = products[:, a : a + FILTERS] + model.bias[k * FILTERS : (k + 1) * FILTERS]
        for j in range(1, width):
            inside = (text[j:] == text[:-j])[:, None]
            value[:-j] += np.where(inside, products[j:, a + j * FILTERS : a + (j + 1) * FILTERS], 0)
        values.append(value)
        pooled[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(value, f.first[some], axis=0)
    return np.maximum(pooled, 0), values, vectors


def logit(model: Model, f: Features) -> np.ndarray:
    return _pool(model, f)[0] @ model.out + model.shift


def language(model: Model, f: Features) -> np.ndarray:
    """The likeliest language by the terms of each text; 0 is the common threshold's place."""
    n = len(f.first) - 1
    if not model.langs.shape[1] or not len(f.langs):
        return np.zeros(n, np.int64)
    some = np.flatnonzero(np.diff(f.first))
    total = np.full((n, model.langs.shape[1]), -np.inf, np.float32)
    total[:, 0] = 0
    total[some] = np.add.reduceat(model.langs[f.langs], f.first[some], axis=0)
    return total.argmax(axis=1)


def scores(model: Model, f: Features) -> np.ndarray:
    at = model.logits[language(model, f)] if model.langs.shape[1] else model.logits[0]
    z = (logit(model, f) - at) * model.scale + np.log(THRESHOLD / (1 - THRESHOLD))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _signal(with_it: np.ndarray, clean: int, toxic: int) -> np.ndarray:
    """For each bucket, by how many standard deviations it prefers toxic texts. ``with_it``: other and
    toxic texts that have a bucket; then how many there are."""
    ratio = toxic / max(1, clean)
    p, q = with_it[1], with_it[0] * ratio
    z = (p - q) / np.sqrt(p + q * ratio + 1)
    return (np.clip(np.where(p + q > 0, z, 0), -8, 8) / 4).T.astype(np.float32)


def _texts(shard: Shard, chosen: np.ndarray) -> Features:
    """The features of some texts of a shard."""
    sizes = np.diff(shard.first)[chosen]
    first = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(shard.first[chosen] - first[:-1], sizes) + np.arange(first[-1])
    terms = shard.vocabulary[shard.codes[at]]
    return Features(terms[:, :3], first, terms[:, 3])


def _step(model: Model, f: Features, labels: np.ndarray, weight: np.ndarray, memory: dict) -> None:
    """One descent step with Adagrad, through the places of the maxima."""
    pooled, values, vectors = _pool(model, f)
    z = pooled @ model.out + model.shift
    wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weight / len(labels)
    grad = {
        "out": pooled.T @ wrong,
        "shift": np.array(wrong.sum()),
        "kernel": np.zeros_like(model.kernel),
        "bias": np.zeros_like(model.bias),
    }
    back = wrong[:, None] * model.out[None, :] * (pooled > 0)
    text = np.repeat(np.arange(len(labels)), np.diff(f.first))
    touched, pushed = [], []
    for k, width in enumerate(WIDTHS):
        a, _ = _columns(width)
        for c in range(FILTERS):
            g = back[:, k * FILTERS + c]
            column = values[k][:, c]
            at = np.flatnonzero((column == pooled[text, k * FILTERS + c]) & (g[text] != 0))
            _, once = np.unique(text[at], return_index=True)
            at = at[once]
            g = g[text[at]]
            grad["bias"][k * FILTERS + c] = g.sum()
            for j in range(width):
                ok = at + j < f.first[text[at] + 1]
                place, own = at[ok] + j, g[ok]
                col = a + j * FILTERS + c
                grad["kernel"][:, col] += own @ vectors[place]
                touched.append(f.rows[place].ravel())
                pushed.append(np.repeat(own[:, None] * model.kernel[:, col][None, :], 3, axis=0))
    for name, g in grad.items():
        memory[name] = memory.get(name, 1e-6) + g * g
        now = getattr(model, name) - RATE * g / np.sqrt(memory[name])
        setattr(model, name, float(now) if name == "shift" else now.astype(np.float32))
    if touched:
        rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        g = np.zeros((len(rows), DIM), np.float32)
        np.add.at(g, inverse, np.concatenate(pushed).astype(np.float32))
        memory["table"][rows] += (g * g).sum(axis=1)
        model.table[rows] -= 0.2 * RATE * g / np.sqrt(memory["table"][rows])[:, None]


def _best(z: np.ndarray, labels: np.ndarray, copies: np.ndarray | None = None) -> float:
    """The middle of the widest gap between logits among the cuts with the best F1."""
    order = np.argsort(z)
    z, labels = z[order], labels[order]
    copies = np.ones(len(z), np.int64) if copies is None else copies[order]
    above = (labels * copies)[::-1].cumsum()[::-1]
    f1 = 2 * above / (copies[::-1].cumsum()[::-1] + (labels * copies).sum())
    below = np.concatenate([[z[0] - 1], z[:-1]])
    good = np.flatnonzero((f1 >= f1.max() - 1e-12) & (z > below))
    if not len(good):
        return float(z[0] - 1)
    gap = good[np.argmax(z[good] - below[good])]
    return float((z[gap] + below[gap]) / 2)


def _in_slices(shard: Shard, which: np.ndarray) -> list[np.ndarray]:
    """``which`` texts in their order, in parts of some ``SLICE_WORDS`` words."""
    before = np.cumsum(np.diff(shard.first)[which])
    return np.split(which, np.flatnonzero(np.diff(before // SLICE_WORDS)) + 1)


@dataclass
class Shard:
    number: int
    vocabulary: np.ndarray  # buckets of each different term, then that for the language
    codes: np.ndarray  # the terms of all texts, by their place in the vocabulary
    first: np.ndarray  # of each text, and the end
    toxic: np.ndarray
    copies: np.ndarray
    spare: np.ndarray
    lang: list[str | None]


PACKED = (
    "shard long, vocabulary binary, codes binary, sizes binary, toxic binary, copies binary, spare binary, "
    "lang array<string>"
)


def _packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The texts of a shard as one row: buckets of its different terms, and the terms of all texts."""
    table = pa.Table.from_batches(parts)
    buckets, langs, sizes = [], [], []
    for batch in T.slices(parts, size=SLICE):
        f = features(T.words_of(batch, kind=T.TERM))
        buckets.append(f.rows @ np.array([1, BUCKETS, BUCKETS**2]))
        langs.append(f.langs)
        sizes.append(np.diff(f.first))
    different = pa.array(np.concatenate(buckets)).dictionary_encode()
    triples = different.dictionary.to_numpy()
    both = different.indices.to_numpy().astype(np.int64) * LANG_BUCKETS + np.concatenate(langs)
    both = pa.array(both).dictionary_encode()
    terms = both.dictionary.to_numpy()
    triple = triples[terms // LANG_BUCKETS]
    parts = [triple % BUCKETS, triple // BUCKETS % BUCKETS, triple // BUCKETS**2, terms % LANG_BUCKETS]
    row = {
        "shard": table.column("shard")[0].as_py(),
        "vocabulary": np.stack(parts, 1).astype(np.int32).tobytes(),
        "codes": both.indices.to_numpy().astype(np.int32).tobytes(),
        "sizes": np.concatenate(sizes).astype(np.int64).tobytes(),
        "toxic": table.column("toxic").to_numpy().astype(np.int64).tobytes(),
        "copies": table.column("copies").to_numpy().astype(np.int64).tobytes(),
        "spare": table.column("spare").to_numpy().astype(np.int8).tobytes(),
        "lang": table.column("lang").to_pylist(),
    }
    kinds = {"shard": pa.int64(), "lang": pa.list_(pa.string())}
    return pa.RecordBatch.from_pydict({c: pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()})


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard; rows come by shard."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        number = batch.column("shard").to_numpy()
        edges = np.flatnonzero(np.diff(number, prepend=-1))
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            if parts and parts[0].column("shard")[0].as_py() != number[a]:
                yield _packed(parts)
                parts = []
            parts.append(batch.slice(a, b - a))
    if parts:
        yield _packed(parts)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}

            def numbers(name: str, kind: type) -> np.ndarray:
                return np.frombuffer(row[name].as_buffer(), kind)

            yield Shard(
                row["shard"].as_py(),
                numbers("vocabulary", np.int32).reshape(-1, 4),
                numbers("codes", np.int32),
                np.concatenate([[0], np.cumsum(numbers("sizes", np.int64))]),
                numbers("toxic", np.int64),
                numbers("copies", np.int64),
                numbers("spare", np.int8) != 0,
                row["lang"].as_py() if "lang" in row else [],
            )


def _batch(schema: str, *columns) -> pa.RecordBatch:
    """Arrow columns for a schema of Spark's names and types."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=names)


#: ``kind`` 0 to 2: texts of each class that have a bucket in that place. 3: terms of a language.
COUNTED = "kind int, lang string, bucket int, clean long, toxic long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over the texts that are trained on."""
    with_it = np.zeros((2, 3, BUCKETS), np.int64)
    spoken: dict[str, np.ndarray] = {}
    for shard in _shards(batches):
        langs = np.array(shard.lang, object)
        for part in _in_slices(shard, np.flatnonzero(~shard.spare)):
            own = _texts(shard, part)
            sizes = np.diff(own.first)
            text = np.repeat(np.arange(len(part)), sizes)
            for k in range(3):
                seen = np.unique(text * BUCKETS + own.rows[:, k])
                of, bucket = seen // BUCKETS, seen % BUCKETS
                for toxic in (0, 1):
                    mine = shard.toxic[part][of] == toxic
                    number = np.bincount(bucket[mine], shard.copies[part][of[mine]], BUCKETS)
                    with_it[toxic, k] += number.astype(np.int64)
            for name in {x for x in langs[part] if x is not None}:
                mine = np.flatnonzero((langs[part] == name)[text])
                number = np.bincount(own.langs[mine], shard.copies[part][text[mine]], LANG_BUCKETS)
                spoken[name] = spoken.get(name, 0) + number.astype(np.int64)
    for k in range(3):
        some = np.flatnonzero(with_it[:, k].any(axis=0))
        yield _batch(COUNTED, np.full(len(some), k), [None] * len(some), some, *with_it[:, k, some])
    for name, number in spoken.items():
        some = np.flatnonzero(number)
        # A language whose texts have no term is one too.
        some = some if len(some) else np.zeros(1, np.int64)
        yield _batch(COUNTED, np.full(len(some), 3), [name] * len(some), some, number[some], np.zeros(len(some)))


DENSE = ("kernel", "bias", "out", "shift")
#: Parameters of one place: a row of the table and its memory, or as many numbers of the others.
VALUES = [f"v{i}" for i in range(DIM + 1)]
MOVED = "place int, shards long, " + ", ".join(f"{v} long" for v in VALUES)


def _flat(model: Model, memory: dict) -> np.ndarray:
    """All parameters and their memories, a place a row."""
    parts = [np.ravel(x) for name in DENSE for x in (getattr(model, name), memory[name])]
    dense = np.concatenate(parts).astype(np.float64)
    dense = np.pad(dense, (0, -len(dense) % len(VALUES))).reshape(-1, len(VALUES))
    return np.concatenate([np.column_stack([model.table, memory["table"]]).astype(np.float64), dense])


def _unflat(flat: np.ndarray, model: Model, memory: dict) -> None:
    """Set all parameters and their memories."""
    model.table, memory["table"] = flat[:BUCKETS, :DIM].astype(np.float32), flat[:BUCKETS, DIM].astype(np.float32)
    dense, at = flat[BUCKETS:].ravel(), 0
    for name in DENSE:
        now = getattr(model, name)
        size, shape = np.size(now), np.shape(now)
        value = dense[at : at + size].reshape(shape)
        setattr(model, name, float(value) if name == "shift" else value.astype(np.float32))
        memory[name] = dense[at + size : at + 2 * size].reshape(shape).copy()
        at += 2 * size


def _descend(shared, epoch: int):
    """What each shard does to a common model in one epoch, added up over the shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, balance = shared.value
        total = np.zeros(begin.shape, np.int64)
        shards = np.zeros(len(begin), np.int64)
        for shard in _shards(batches):
            use = np.flatnonzero(~shard.spare)
            if not len(use):
                continue
            model, memory = _blank(), {}
            _unflat(begin, model, memory)
            order = np.random.default_rng([8, epoch, shard.number]).permutation(use)
            for at in range(0, len(order), BATCH):
                for part in _in_slices(shard, order[at : at + BATCH]):
                    weight = balance[shard.toxic[part]] * shard.copies[part] / shard.copies[part].mean()
                    _step(model, _texts(shard, part), shard.toxic[part], weight, memory)
            move = _flat(model, memory)
            move -= begin
            move = np.rint(move * FIXED, out=move).astype(np.int64)
            touched = move.any(axis=1)
            touched[BUCKETS:] = True
            total += move
            shards += touched
        some = np.flatnonzero(shards)
        for part in np.split(some, range(SLICE_WORDS, len(some), SLICE_WORDS)):
            yield _batch(MOVED, part, shards[part], *total[part].T)

    return run


#: Texts of each class by their language, as told from their words, and logit.
LOGITS = "spoken int, z int, clean long, toxic long"


def _logits(shared, spare_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for shard in _shards(batches):
            check = np.flatnonzero(shard.spare | (not spare_only))
            for part in _in_slices(shard, check):
                own = _texts(shard, part)
                z = np.rint(np.clip(logit(model, own), -FAR, FAR) * STEPS)
                toxic = shard.toxic[part] * shard.copies[part]
                yield _batch(LOGITS, language(model, own), z, shard.copies[part] - toxic, toxic)

    return run


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, toxic, spare: a bounded sample of the labelled texts, to look at; ``fit`` learns
    from all of them. Ids are chosen from the labels alone; a class has twice ``PER_CLASS`` candidates, for
    texts that are too long."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1)).distinct()
    # The lowest hashes of a class, by a limit from its size, before they meet in one task.
    drawn, most = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)), F.lit(0)
    for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        limit = int((1 << 32) * min(1.0, 3 * PER_CLASS / row.n))
        most = F.when(F.col("toxic") == row.toxic, limit).otherwise(most)
    order = W.partitionBy("toxic").orderBy(drawn, "doc_id")
    chosen = rows.where(drawn < most).withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2 * PER_CLASS)
    found = docs.select("doc_id", "text", "lang").where(F.length("text") <= SAMPLE_CHARS).join(
        F.broadcast(chosen), "doc_id"
    )
    again = W.partitionBy("toxic").orderBy("n", "text", "lang")
    return (
        found.withColumn("n", F.row_number().over(again))
        .where(F.col("n") <= PER_CLASS)
        .withColumn("spare", F.xxhash64("doc_id", F.lit(1)) % 4 == 0)
        .drop("n")
    )


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, toxic, copies, spare: every labelled text outside the held-out third, equal rows
    as one. Texts without a label are not shuffled, but for a few that a Bloom filter lets pass."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1)).distinct()
    rows = materialize(rows, "labels")
    given = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    return (
        prefilter.may_be_in(given, "doc_id", rows, "has_label")
        .where("has_label")
        .drop("has_label")
        .join(rows, "doc_id")
        .groupBy("doc_id", "text", "lang", "toxic")
        .agg(F.count("*").alias("copies"))
        .withColumn("spare", F.xxhash64("doc_id", F.lit(1)) % 4 == 0)
    )


def shards(rows: DataFrame) -> DataFrame:
    """The labelled texts, a shard a row, stored."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-size // SHARD_BYTES))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)))
    # Shards of a task stay apart, and each is met in one order, wherever its texts come from.
    dealt = dealt.repartitionById(min(number, SHARD_TASKS), F.pmod("shard", F.lit(SHARD_TASKS)).cast("int"))
    dealt = dealt.sortWithinPartitions("shard", "doc_id", "toxic", "text", "lang")
    return materialize(dealt.mapInArrow(_pack, PACKED), "shards")


def _blank() -> Model:
    """A model that finds nothing."""
    return Model(
        np.zeros((BUCKETS, DIM), np.float32),
        np.zeros((DIM, sum(WIDTHS) * FILTERS), np.float32),
        np.full(len(WIDTHS) * FILTERS, -0.1, np.float32),
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        -20.0,
    )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the labelled texts that are not ``spare``, calibrate on those that are."""
    context = docs.sparkSession.sparkContext
    rows = materialize(labelled(docs, labels), "labelled")
    number = {(r.spare, r.toxic): r.n for r in rows.groupBy("spare", "toxic").agg(F.sum("copies").alias("n")).collect()}
    clean, toxic = number.get((False, 0), 0), number.get((False, 1), 0)
    model = _blank()
    if not (clean and toxic):
        return model
    packed = shards(rows)
    counts = (
        packed.mapInArrow(_count, COUNTED)
        .groupBy("kind", "lang", "bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    kind, bucket, ones, others = (counts.column(c).to_numpy() for c in ("kind", "bucket", "toxic", "clean"))
    with_it = np.zeros((2, 3, BUCKETS), np.int64)
    of_texts = kind < 3
    with_it[0, kind[of_texts], bucket[of_texts]] = others[of_texts]
    with_it[1, kind[of_texts], bucket[of_texts]] = ones[of_texts]
    signal = _signal(with_it, clean, toxic)

    draw = np.random.default_rng(8)
    model.kernel = draw.normal(0, 0.15, model.kernel.shape).astype(np.float32)
    model.out = np.abs(draw.normal(0, 0.3, model.out.shape)).astype(np.float32)
    model.shift = -0.5
    model.table[:, :3] = signal
    model.table[:, 3:] = draw.normal(0, 0.02, (BUCKETS, DIM - 3)) * (signal != 0).any(axis=1)[:, None]
    model.kernel[:3] = np.abs(model.kernel[:3]) + 0.3
    memory = {name: np.full(np.shape(getattr(model, name)), 1e-6) for name in DENSE}
    memory["table"] = np.full(BUCKETS, 1e-2, np.float32)
    balance = (clean + toxic) / 2 / np.array([clean, toxic])
    flat, texts = _flat(model, memory), packed.drop("lang")
    for epoch in range(EPOCHS):
        shared = context.broadcast((flat, balance))
        moved = texts.mapInArrow(_descend(shared, epoch), MOVED).groupBy("place")
        moved = moved.agg(*(F.sum(c).alias(c) for c in ("shards", *VALUES))).toArrow()
        place, by = moved.column("place").to_numpy(), moved.column("shards").to_numpy()
        flat = flat.copy()
        for i, v in enumerate(VALUES):
            flat[place, i] += moved.column(v).to_numpy() / FIXED / by
        shared.destroy()
    _unflat(flat, model, memory)

    names = sorted(set(counts.column("lang").drop_null().to_pylist()))
    terms = np.zeros((LANG_BUCKETS, len(names)), np.float64)
    if names:
        of_lang = np.flatnonzero(~of_texts)
        spoken = np.searchsorted(names, counts.column("lang").take(pa.array(of_lang)).to_pylist())
        terms[bucket[of_lang], spoken] = others[of_lang]
    model.langs = np.log((terms + 0.5) / (terms.sum(axis=0) + 0.5 * LANG_BUCKETS)).astype(np.float32)

    shared = context.broadcast(model)
    z = (
        texts.mapInArrow(_logits(shared, number.get((True, 1), 0) >= 3), LOGITS)
        .groupBy("spoken", "z")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    shared.destroy()
    spoken, z, others, ones = (np.tile(z.column(c).to_numpy(), 2) for c in ("spoken", "z", "clean", "toxic"))
    label = np.repeat([0, 1], len(z) // 2)
    copies = np.where(label == 1, ones, others)
    some = copies > 0
    spoken, z, label, copies = spoken[some], z[some] / STEPS, label[some], copies[some]
    model.logits = np.full(max(1, len(names)), _best(z, label, copies))
    for k in range(len(names)):
        own = spoken == k
        if (label * copies)[own].sum() >= LANG_LEAST and (label[own] == 0).any():
            model.logits[k] = _best(z[own], label[own], copies[own])
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in T.slices(batches, size=SLICE):
            value = scores(model, features(T.words_of(batch, kind=T.TERM)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(value, pa.float64()),
                    pa.array((value >= THRESHOLD).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(
        _score(shared), f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
