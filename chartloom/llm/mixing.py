"""Mixing sources to target weights by entropy balancing.

Targets: source number i by code point (null last) weighs 5, 2, 1, 5, ... and is given its part of
150% of all words, at most twice its own; what is cut is shared again by weight among the others
until none is above. That fills all sources to one level, target = min(2 * size, weight * level).

Rates: of all rates whose words add up to each source's target, those closest to "every document once",
    minimise sum (r log r - r + 1)  subject to  sum over a source of size * r = target,  r <= 2.
They are exponentially tilted, r = min(2, exp(tilt of the source * size)): every document counts the
same in the objective, so where words must go, long documents lose more than short ones, and where words
are to come, gain more. The tilts maximise the concave dual. Its gradient, target less words taken, and
its second derivative need one distributed sum over the size classes of each source for a Newton step; a step
that leaves the interval known to hold the tilt is replaced by its middle, so the steps end. Tilts
live in a table with a row per source; only the number of unfinished sources comes to the driver.

Copies: a rate is rounded to one of the whole numbers next to it. Within blocks of a source, from
the longest document to the shortest, each goes the way that keeps the words taken nearest to the
words due, so that a block ends within about its shortest documents of its target. Large sources
have many blocks, dealt by a hash of the document, each its own task-sized group. Rows equal in id, text and
source are one with a count, in chunks of a block's size at most, and share their copies evenly.

Nulls: a null text has no words, a null source is a source, the last one; a null doc_id is carried.
Repeated rows are rows of their own. An empty table gives an empty result. The outcome depends on the
rows alone, not on their order or partitions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.operators.ordinal import dense_index
from chartloom.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Relative gap to the target at which a source is done, and steps after which it is in any case (halving
#: alone takes fewer to the last digit of a double).
TOLERANCE, STEPS = 1e-10, 200
#: Documents in a block of the rounding.
BLOCK = 2_000


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target and docs of each source. ``sized`` has source, size and rows, how often."""
    sizes = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("docs")
    )
    numbered = dense_index(
        sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "number"
    ).drop("last")
    weight = F.element_at(
        F.array(*(F.lit(w) for w in WEIGHTS)), (F.pmod("number", F.lit(len(WEIGHTS))) + 1).cast("int")
    )
    weighed = materialize(
        numbered.withColumn("weight", weight).withColumn("full", F.col("source_size") * MOST),
        "sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = _level(weighed, SHARE * total)
    return weighed.select(
        "source", "source_size", "docs", F.least("full", F.col("weight") * level).alias("target")
    )


def _level(weighed: DataFrame, budget: float) -> float:
    """The level at which min(full, weight * level) adds up to ``budget``: each step shares among
    the sources that are not full what the full ones leave, and more become full."""
    level, full = 0.0, -1
    while True:
        is_full = F.col("full") <= F.col("weight") * level
        row = weighed.agg(
            F.count_if(is_full),
            F.coalesce(F.sum(F.when(is_full, F.col("full"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if row[0] == full or not row[2]:
            return level
        full, level = row[0], max(0.0, budget - row[1]) / row[2]


def rates(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, size and rate of each size class, by safeguarded Newton steps on the dual.

    Sizes are measured in the source's smallest positive one, u >= 1. A source is full, rate 2, where its
    target is twice its size; else its tilt is between 0 and log(target / source_size), if that is below
    0, and between 0 and log 2 otherwise.
    """
    classes = sized.where("size > 0").groupBy("source", "size").agg(F.sum("rows").alias("n"))
    classes = materialize(classes, "size-classes")
    least = classes.groupBy(F.col("source").alias("s")).agg(F.min("size").alias("unit"))
    share = F.col("target") / F.col("source_size")
    state = wanted.where("source_size > 0").join(least, F.col("source").eqNullSafe(F.col("s"))).select(
        "source",
        "target",
        "unit",
        F.lit(0.0).alias("tilt"),
        F.least(F.lit(0.0), F.log(share)).alias("low"),
        F.when(share > 1, F.lit(math.log(MOST))).otherwise(0.0).alias("high"),
        (share >= MOST * (1 - 1e-12)).alias("full"),
    )
    state = materialize(state.withColumn("done", F.col("full")), "tilts")
    for _ in range(STEPS):
        going = state.where("NOT done")
        if going.isEmpty():
            break
        state = materialize(state.where("done").unionByName(_step(classes, going)), "tilts")
    tilted = _tilted(classes, state).withColumn("rate", F.when(F.col("full"), MOST).otherwise(F.least(F.lit(MOST), "raw")))
    # Sums of doubles differ in their last digits between runs; rates must not.
    return tilted.select("source", "size", F.round("rate", 9).alias("rate"))


def _tilted(classes: DataFrame, state: DataFrame) -> DataFrame:
    own = state.withColumnRenamed("source", "s")
    joined = classes.join(own, F.col("source").eqNullSafe(F.col("s"))).withColumn("u", F.col("size") / F.col("unit"))
    return joined.withColumn("raw", F.exp(F.col("tilt") * F.col("u")))


def _step(classes: DataFrame, going: DataFrame) -> DataFrame:
    """One step of the tilts that are not done."""
    words = F.col("n") * F.col("size")
    free = F.col("raw") < MOST
    sums = _tilted(classes, going).groupBy(F.col("source").alias("s")).agg(
        F.sum(words * F.least(F.lit(MOST), "raw")).alias("taken"),
        F.sum(F.when(free, words * F.col("u") * F.col("raw")).otherwise(0.0)).alias("slope"),
    )
    gap = F.col("taken") - F.col("target")
    low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
    newton = F.col("tilt") - gap / F.nullif("slope", F.lit(0.0))
    inside = (newton > F.col("low")) & (newton < F.col("high"))
    near = (F.abs(gap) <= TOLERANCE * F.col("target")) | (F.col("high") - F.col("low") <= 1e-15 * F.abs(F.col("tilt")))
    moved = going.join(sums, F.col("source").eqNullSafe(F.col("s"))).withColumns({"low": low, "high": high, "gap": gap})
    middle = (F.col("low") + F.col("high")) / 2
    return moved.withColumn("done", near).select(
        "source",
        "target",
        "unit",
        F.when(F.col("done"), F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"),
        "low",
        "high",
        "full",
        "done",
    )


def _copies(sizes: np.ndarray, rates: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole copies for documents in descending order of size: of all the ``rows`` equal ones together, of
    each one of the whole numbers next to its rate. A document goes the nearer way, or the other if what
    comes after it could not make up for that: by going down where it is due words, or by going up."""
    low = np.floor(rates + 1e-9)
    part = np.where(np.abs(rates - low) < 1e-9, 0.0, rates - low)
    words = rows * sizes
    down, up = (np.append(np.cumsum((words * p)[::-1])[::-1], 0.0)[1:] for p in (part, (part > 0) * (1 - part)))
    out, behind = np.empty(len(sizes), np.int64), 0.0
    for i, (size, n, p) in enumerate(zip(sizes.tolist(), rows.tolist(), part.tolist(), strict=True)):
        due, more = behind + n * p * size, 0
        if p and size:
            least, most = math.ceil((due - up[i]) / size), math.floor((due + down[i]) / size)
            more = min(n, max(0, min(max(round(due / size), least), max(most, least))))
        out[i], behind = n * int(low[i]) + more, due - more * size
    return out


def _round(block: pd.DataFrame) -> pd.DataFrame:
    order = ["size", "doc_id", "digest", "chunk"]
    block = block.sort_values(order, ascending=[False, True, True, True], kind="stable")
    block["copies"] = _copies(block["size"].to_numpy(), block["rate"].to_numpy(), block["rows"].to_numpy())
    return block


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, digest (hash of id and text), source, size, source_size, target, rate, rows and copies:
    a row for up to ``BLOCK`` equal rows of ``docs`` (doc_id, text, source), with what they take together."""
    sized = docs.select(
        "doc_id", "source", n_words().alias("size"), F.xxhash64("doc_id", "text").alias("digest")
    )
    sized = materialize(sized.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("rows")), "sized")
    wanted = materialize(targets(sized), "targets")
    rated = materialize(rates(sized, wanted), "rates").withColumnsRenamed({"source": "r", "size": "r_size"})
    chunks = F.ceil(F.col("rows") / BLOCK).cast("long")
    share = F.floor(F.col("rows") / chunks) + F.when(F.col("chunk") < F.col("rows") % chunks, 1).otherwise(0)
    cut = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    cut = cut.withColumn("rows", share.cast("long"))
    joined = (
        cut.join(wanted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .join(rated, F.col("source").eqNullSafe(F.col("r")) & (F.col("size") == F.col("r_size")), "left")
        .withColumn("block", F.pmod(F.xxhash64("digest", "chunk"), F.ceil(F.col("docs") / BLOCK).cast("long")))
        .select(
            "doc_id", "digest", "source", "size", "source_size", "target",
            F.coalesce("rate", F.lit(1.0)).alias("rate"), "rows", "chunk", "block",
        )
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema)
    return joined.groupBy("source", "block").applyInPandas(_round, f"{kinds}, copies long").drop("block", "chunk")


def _share(copies: Column, rows: Column, place: Column) -> Column:
    """What the row at ``place`` of several equal ones takes of the copies of all."""
    return F.floor(copies / rows) + F.when(place < copies % rows, 1).otherwise(0)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of all copies), rate and copies of every row."""
    found = copies(docs).withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    found = found.withColumn("copies", _share(F.col("copies"), F.col("rows"), F.col("place")).cast("long"))
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "rate",
        "copies",
    )


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as its copies say. Rows equal in id, text and source share
    their copies as evenly as whole numbers allow."""
    keys = ("doc_id", "digest", "source", "copies", "rows")
    total = copies(docs.select("doc_id", "text", "source")).groupBy("doc_id", "digest", "source")
    total = total.agg(F.sum("copies").alias("copies"), F.sum("rows").alias("rows"))
    total = total.where("copies > 0").select(*(F.col(c).alias(f"_mix_{c}") for c in keys))
    total = materialize(total, "copies")
    same = (
        (F.col("_mix_own") == F.col("_mix_digest"))
        & F.col("doc_id").eqNullSafe(F.col("_mix_doc_id"))
        & F.col("source").eqNullSafe(F.col("_mix_source"))
    )
    rows = docs.withColumn("_mix_own", F.xxhash64("doc_id", "text"))
    times = F.col("_mix_copies")
    once = rows.join(total.where("_mix_rows = 1"), same).withColumn("_mix_times", times)
    out = _repeated(once, docs.columns)
    if total.where("_mix_rows > 1").isEmpty():
        return out
    # Equal rows are one with a count before they are numbered, so a group is as long as it has different rows.
    several = rows.join(total.where("_mix_rows > 1"), same)
    every = F.xxhash64(F.to_json(F.struct(*(f"`{c}`" for c in docs.columns))))
    group = ["_mix_doc_id", "_mix_digest", "_mix_source", "_mix_copies", "_mix_rows"]
    alike = several.withColumn("_mix_every", every).groupBy(*group, "_mix_every").agg(
        F.count("*").alias("_mix_n"), F.first(F.struct(*(f"`{c}`" for c in docs.columns))).alias("_mix_row")
    )
    before = W.partitionBy(*group).orderBy("_mix_every").rowsBetween(W.unboundedPreceding, -1)
    more = times % F.col("_mix_rows")
    first = F.coalesce(F.sum("_mix_n").over(before), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("_mix_n"), more - F.col("_mix_first")))
    alike = alike.withColumn("_mix_first", first).withColumn(
        "_mix_times", F.col("_mix_n") * F.floor(times / F.col("_mix_rows")) + extra
    )
    pieces = alike.select("_mix_row.*", "_mix_times")
    return out.unionByName(_repeated(_in_pieces(pieces), docs.columns))


def _in_pieces(rows: DataFrame) -> DataFrame:
    """Rows that are to come very often, cut into rows for ``BLOCK`` times, on several tasks."""
    count = F.ceil(F.col("_mix_times") / BLOCK).cast("long")
    cut = rows.where("_mix_times > 0").withColumn("_mix_piece", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    left = F.least(F.lit(BLOCK), F.col("_mix_times") - F.col("_mix_piece") * BLOCK)
    return cut.withColumn("_mix_times", left).hint("rebalance")


def _repeated(rows: DataFrame, columns: list[str]) -> DataFrame:
    times = F.explode(F.array_repeat(F.lit(0), F.col("_mix_times").cast("int")))
    return rows.withColumn("_mix_copy", times).select(*(f"`{c}`" for c in columns))
