"""Quality rules: fixed base rules, then fences learned per language and source.

Every text gets its counts in one pass. Three measures derived from them go into quantile sketches:
integer buckets of at most 1/32 relative width, whose counts are simply added, so that sketches
merge in any order with the same outcome. A group with too few texts borrows the merged sketch of
its language, and a small language that of the whole collection. A text is rejected where a measure
lies outside the fence [q1 - reach * spread, q3 + reach * spread] of its group.

Nulls: a null text has no words and fails the base rules; null language and null source are groups
of their own. Repeated rows are judged one by one, alike. An empty table gives an empty result.
Columns beyond the five of ``documents`` are carried or dropped by the caller, never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm import text as T
from chartloom.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
MIN_GROUP = 200
REACH = 3
#: Measure -> least spread, in its own unit, so that a group of equal values has a fence at all.
MEASURES = {"symbol_rate": 15, "dup_line_rate": 20, "word_length": 60}

_SYMBOL = np.zeros(256, np.int8)
_SYMBOL[list(b"#*$%&|<>")] = 1
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SPACE = " \t\n\x0b\x0c\r"


def _repeated(words: T.Words) -> np.ndarray:
    """Whether each word lies in a window that occurs twice or more in its text."""
    at = words.windows(REPEAT_WINDOW)
    value = T.window_hashes(words.hashes(), at, REPEAT_WINDOW)
    value = T.mix(value + words.of_text()[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(value)
    same = value[order][1:] == value[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words.starts) + REPEAT_WINDOW + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + REPEAT_WINDOW, -1)
    return np.cumsum(change)[: len(words.starts)] > 0


def _dup_lines(text: str | None) -> int:
    lines = [line for line in (text or "").split("\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        words = T.words_of(batch)
        points = words.inside & ((words.data & 0xC0) != 0x80)
        columns = [
            words.counts,
            words.per_text(points),
            words.per_text(_SYMBOL[words.data]),
            [_dup_lines(x) for x in batch.column("text").to_pylist()],
            words.sum_words(_repeated(words)),
        ]
        names = [c.split()[0] for c in COUNTS.split(", ")]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *arrays], names=[*batch.schema.names, *names]
        )


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the five counts of each text; replaces columns of these names."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    docs = docs.drop(*names)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_count, f"{kept}, {COUNTS}")


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measures() -> dict[str, Column]:
    """Whole numbers: symbols per 1000 word characters, repeated lines per 1000 words, hundredths
    of characters per word. Divisors are at least 1."""
    return {
        "symbol_rate": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
        "dup_line_rate": F.expr("1000 * n_dup_lines div greatest(n_words, 1)"),
        "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
    }


def bucket(name: str) -> Column:
    """Lower edge of the sketch bucket: exact below 64, then 32 buckets for each power of two."""
    width = f"shiftleft(1L, greatest(length(bin({name})) - 6, 0))"
    return F.expr(f"{name} - {name} % {width}")


def sketches(counted: DataFrame) -> DataFrame:
    """Bucket counts per language, source and measure, of texts that pass the base rules; the
    sketches of a language and of everything are sums of these (``level`` 0, 1, 2)."""
    values = counted.where(~base_failed()).select("lang", "source", *_named(measures()))
    long = values.select(
        "lang",
        "source",
        F.explode(
            F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES))
        ).alias("m"),
    ).select("lang", "source", "m.measure", "m.value")
    cells = long.groupBy("lang", "source", "measure", bucket("value").alias("bucket")).agg(
        F.count("*").alias("n")
    )
    return cells


def _fences(cells: DataFrame, by: list[str]) -> DataFrame:
    """One row per group in ``by``: its size and, for each measure, the ends of the fence."""
    merged = cells.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*by, "measure")
    ranked = merged.withColumns(
        {
            "upto": F.sum("n").over(group.orderBy("bucket")),
            "size": F.sum("n").over(group),
        }
    )

    def quantile(q: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= q * F.col("size"), F.col("bucket")))

    ends = ranked.groupBy(*by, "measure").agg(
        F.max("size").alias("size"), quantile(1).alias("q1"), quantile(3).alias("q3")
    )
    least = F.create_map(*(F.lit(x) for pair in MEASURES.items() for x in pair))
    spread = REACH * F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")])
    fences = ends.select(
        *by, "measure", "size", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")
    )
    parts = [F.max("size").alias("size")]
    for m in MEASURES:
        own = F.col("measure") == m
        parts += [F.max(F.when(own, F.col(c))).alias(f"{m}_{c}") for c in ("low", "high")]
    return fences.groupBy(*by).agg(*parts)


def thresholds(cells: DataFrame) -> DataFrame:
    """One row per language and source: the fences of the smallest of group, language and whole
    collection that has ``MIN_GROUP`` texts; of the whole collection if none has."""
    ends = [f"{m}_{c}" for m in MEASURES for c in ("low", "high")]

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            *(F.col(c) for c in df.columns if c not in ("size", *ends)),
            *(F.col(c).alias(prefix + c) for c in ("size", *ends)),
        )

    own = named(_fences(cells, ["lang", "source"]), "a_")
    by_lang = named(_fences(cells, ["lang"]), "b_").withColumnRenamed("lang", "b_lang")
    whole = named(_fences(cells.withColumn("one", F.lit(1)), ["one"]), "c_").drop("one")
    joined = own.join(by_lang, own["lang"].eqNullSafe(by_lang["b_lang"]), "left").join(
        F.broadcast(whole), F.lit(True), "left"
    )
    pick = (
        F.when(F.col("a_size") >= MIN_GROUP, F.lit("a_"))
        .when(F.col("b_size") >= MIN_GROUP, F.lit("b_"))
        .otherwise(F.lit("c_"))
    )
    chosen = joined.withColumn("pick", pick)
    return chosen.select(
        F.col("lang").alias("t_lang"),
        F.col("source").alias("t_source"),
        *(
            F.when(F.col("pick") == "a_", F.col("a_" + e))
            .when(F.col("pick") == "b_", F.col("b_" + e))
            .otherwise(F.col("c_" + e))
            .alias(e)
            for e in ends
        ),
    )


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept``. ``limits`` has a row for each group with a text that
    passes the base rules, so a text without limits has failed them."""
    inside = F.lit(True)
    for m, value in measures().items():
        inside &= value.between(F.col(f"{m}_low"), F.col(f"{m}_high"))
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    names = [c for c in counted.columns if c not in ("base_failed", "kept")]
    return (
        counted.select(*(f"`{c}`" for c in names))
        .join(limits, same, "left")
        .withColumn("base_failed", base_failed())
        .select(
            *(f"`{c}`" for c in names),
            "base_failed",
            (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        )
    )


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, ``base_failed`` and ``kept`` of every row.

    The counts are stored once, without the texts; sketches and verdicts read them from there.
    """
    counted = materialize(
        with_counts(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality"
    )
    limits = materialize(thresholds(sketches(counted)), "quality-limits")
    return judge(counted, limits).drop("lang", "source")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged. Limits are small by nature and stored, so
    that the planner knows their size; texts are counted again rather than shuffled."""
    plain = docs.select("text", "lang", "source")
    limits = materialize(
        thresholds(materialize(sketches(with_counts(plain)), "quality-sketch")), "quality-limits"
    )
    rest = [c for c in docs.columns if c not in plain.columns]
    packed = docs.select(*plain.columns, F.struct(F.lit(0), *(f"`{c}`" for c in rest)).alias("rest"))
    kept = judge(with_counts(packed), limits).where("kept")
    return kept.select(
        *(c if c in plain.columns else F.col(f"rest.`{c}`").alias(c) for c in docs.columns)
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]
