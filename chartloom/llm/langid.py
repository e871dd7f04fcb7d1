"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read word by word; a word is the bytes between white space, with a space on either side, in
stretches of at most ``STRETCH`` bytes. One recurrent layer runs forwards and one backwards over a
stretch, and a softmax of both states labels every position with a language. A document's
probabilities are the mean over all its positions; the score is that of the likeliest language.

As the states begin afresh with every stretch, equal stretches have equal labels: within a slice of
texts each distinct one is run once and counted as often as it occurs, which is the same sum.

Training is backpropagation through time in numpy, on a bounded sample: per language at most
``PER_LANG`` texts in the order of a hash of the id, none longer than ``SAMPLE_CHARS``. Languages are
the values that occur in ``lang``, the ``MOST_LANGS`` most frequent of them. A language, source or id is never read when predicting.

Nulls: a null text, and one without a letter (``str.isalpha``), is ``und`` with score 0; rows with null lang or null id
are not learned from. Repeated rows are predicted alike. An empty table gives an empty result; without
anything to learn from all texts are ``und``. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm import text as T

PER_LANG = 200
SAMPLE_CHARS = 20_000
STRETCH = 32
HIDDEN = 12
STEPS = 700
BATCH = 256
RATE = 0.01
UNKNOWN = "und"
SLICE = 4 << 20
#: Stretches run at once.
WIDE = 2048
#: Languages learned at most, those with most rows: what is learned from has a bound, whatever is in ``lang``.
MOST_LANGS = 200


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@dataclass
class Model:
    langs: list[str]
    byte: np.ndarray  # 2 x 256 x 3H: what a byte adds to update, reset and candidate
    state: np.ndarray  # 2 x H x 3H
    out: np.ndarray  # 2H x languages
    shift: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _states(model: Model, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """n x length x 2H states of equally long rows of bytes; ``keep`` gets what training needs."""
    n, length = codes.shape
    out = np.empty((n, length, 2 * HIDDEN), np.float32)
    for way in range(2):
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            x = model.byte[way][codes[:, t]]
            s = h @ model.state[way]
            gates = _sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            candidate = np.tanh(x[:, 2 * HIDDEN :] + reset * s[:, 2 * HIDDEN :])
            new = candidate + update * (h - candidate)
            if keep is not None:
                keep.append((way, t, h, s, update, reset, candidate))
            h = new
            out[:, t, way * HIDDEN : (way + 1) * HIDDEN] = h
    return out


def _labels(model: Model, states: np.ndarray) -> np.ndarray:
    z = states @ model.out + model.shift
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def _gradients(model: Model, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions, by backpropagation through time."""
    keep: list = []
    states = _states(model, codes, keep)
    wrong = _labels(model, states)
    n, length, _ = wrong.shape
    wrong[np.arange(n)[:, None], np.arange(length)[None, :], target[:, None]] -= 1
    wrong /= n * length
    g_out = states.reshape(-1, 2 * HIDDEN).T @ wrong.reshape(n * length, -1)
    back = wrong @ model.out.T
    g_byte, g_state = np.zeros_like(model.byte), np.zeros_like(model.state)
    carried, last = np.zeros((n, HIDDEN), np.float32), None
    for way, t, h, s, update, reset, candidate in reversed(keep):
        if way != last:
            carried, last = np.zeros((n, HIDDEN), np.float32), way
        d = carried + back[:, t, way * HIDDEN : (way + 1) * HIDDEN]
        d_candidate = d * (1 - update) * (1 - candidate * candidate)
        d_update = d * (h - candidate) * update * (1 - update)
        d_reset = d_candidate * s[:, 2 * HIDDEN :] * reset * (1 - reset)
        d_s = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
        d_x = np.concatenate([d_update, d_reset, d_candidate], axis=1)
        np.add.at(g_byte[way], codes[:, t], d_x)
        g_state[way] += h.T @ d_s
        carried = d * update + d_s @ model.state[way].T
    return [g_byte, g_state, g_out, wrong.reshape(n * length, -1).sum(axis=0)]


def _stretches(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of each stretch."""
    sizes = words.ends - words.starts
    parts = -(-sizes // STRETCH)
    word = np.repeat(np.arange(len(sizes)), parts)
    number = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = words.starts[word] + number * STRETCH
    return begin, np.minimum(begin + STRETCH, words.ends[word]), words.of_text()[word]


def _codes(data: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """The bytes of stretches of one size, with a space on either side."""
    out = np.full((len(begin), size + 2), 32, np.uint8)
    out[:, 1:-1] = data[begin[:, None] + np.arange(size)[None, :]]
    return out


def train(texts: list[str], langs: list[str]) -> Model:
    draw = np.random.default_rng(10)
    names = sorted(set(langs))
    words = T.Words(*T.texts(pa.array(texts, pa.large_string())))
    begin, end, text = _stretches(words)
    target = np.array([names.index(x) for x in langs], np.int64)[text]
    sizes = end - begin
    # Every language is drawn alike, and stretches of one length at a time.
    weight = (1 / np.maximum(1, np.bincount(target, minlength=len(names))))[target]
    groups = [np.flatnonzero(sizes == n) for n in range(1, STRETCH + 1)]
    mass = np.array([weight[g].sum() * n for n, g in enumerate(groups, 1)])
    model = Model(
        names,
        draw.normal(0, 0.3, (2, 256, 3 * HIDDEN)).astype(np.float32),
        draw.normal(0, HIDDEN**-0.5, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32),
        draw.normal(0, 0.2, (2 * HIDDEN, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    if not len(begin):
        return model
    values = [model.byte, model.state, model.out, model.shift]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    shares = [np.cumsum(weight[g]) for g in groups]
    for step in range(1, STEPS + 1):
        size = int(draw.choice(STRETCH, p=mass / mass.sum()))
        drawn = np.searchsorted(shares[size], draw.random(BATCH) * shares[size][-1])
        chosen = groups[size][np.minimum(drawn, len(groups[size]) - 1)]
        codes = _codes(words.data, begin[chosen], size + 1)
        rate = RATE * (1 - 0.9 * step / STEPS)
        for v, m, s, g in zip(values, first, second, _gradients(model, codes, target[chosen]), strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return model


def probabilities(model: Model, words: T.Words) -> np.ndarray:
    """Mean over all positions of each text; zeros for a text without a word."""
    n, k = len(words.counts), len(model.langs)
    begin, end, text = _stretches(words)
    if not len(begin) or not k:
        return np.zeros((n, k))
    sizes = end - begin
    # 64 bits of a stretch's bytes: of the words themselves, or of parts of long ones.
    parts = T.Words.__new__(T.Words)
    parts.data, parts.starts, parts.ends, parts.inside = words.data, begin, end, words.inside
    _, one, which = np.unique(parts.hashes(), return_index=True, return_inverse=True)
    summed = np.zeros((len(one), k), np.float32)
    order = np.argsort(sizes[one], kind="stable")
    edges = np.searchsorted(sizes[one][order], np.arange(1, STRETCH + 2))
    for size in range(1, STRETCH + 1):
        group = order[edges[size - 1] : edges[size]]
        for at in range(0, len(group), WIDE):
            part = group[at : at + WIDE]
            codes = _codes(words.data, begin[one[part]], size)
            summed[part] = _labels(model, _states(model, codes)).sum(axis=1)
    total = np.zeros((n, k))
    first = np.searchsorted(text, np.arange(n + 1))
    some = np.flatnonzero(np.diff(first))
    total[some] = np.add.reduceat(summed[which], first[some], axis=0)
    places = np.zeros(n)
    places[some] = np.add.reduceat(sizes + 2, first[some])
    return total / np.maximum(places, 1)[:, None]


def sample(docs: DataFrame) -> DataFrame:
    """doc_id, lang and text of the bounded sample; ids are chosen before texts are moved. Repeated
    rows count once, and an id's further texts come after the first ones of all ids."""
    known = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    able = docs.where(known & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    often = able.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS)
    able = able.join(F.broadcast(often.select("lang")), "lang", "left_semi")
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        able.select("doc_id", "lang")
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= PER_LANG)
        .select("doc_id", "lang")
    )
    found = able.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).distinct()
    place = F.row_number().over(W.partitionBy("lang", "doc_id").orderBy("text"))
    again = W.partitionBy("lang").orderBy("place", F.xxhash64("doc_id"), "doc_id", "text")
    return (
        found.withColumn("place", place)
        .withColumn("n", F.row_number().over(again))
        .where(F.col("n") <= PER_LANG)
        .select("doc_id", "lang", "text")
    )


def fit(docs: DataFrame) -> Model:
    table = sample(docs).toArrow().sort_by([(c, "ascending") for c in ("doc_id", "lang", "text")])
    return train(table.column("text").to_pylist(), table.column("lang").to_pylist())


def _predict(shared):
    names = ["doc_id", "held_out", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in T.slices(batches, size=SLICE):
            p = probabilities(model, T.words_of(batch))
            texts = batch.column("text").to_pylist()
            known = np.array([bool(model.langs) and t is not None and any(map(str.isalpha, t)) for t in texts])
            best = p.argmax(axis=1) if model.langs else np.zeros(len(texts), int)
            score = np.where(known, p.max(axis=1) if model.langs else 0.0, 0.0)
            lang = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))],
                names=names,
            )

    return run


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(
        _predict(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
