"""Tables whose rows lie in segments by key, so that a deletion rewrites few files.

A key's segment comes from its hash; a segment with very many rows is written by several tasks, as
adaptive execution cuts it. Beside the rows each segment has a Bloom filter of its keys. Both are tables of
the same version. A deletion asks the filters which segments may hold one of its keys, writes what
is left of these to a new folder, and takes over all other segments' files as they are.
"""

from __future__ import annotations

from dataclasses import replace as changed

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators import keyfilter
from chartloom.operators.integrity import without_parent
from chartloom.session import materialize
from chartloom.sinks.tables import SEGMENT, Change, fit, segmented
from chartloom.sinks.versions import Part

#: Rows of a segment to aim at, and segments of a table at most: their numbers are in the version file.
SEGMENT_ROWS, MOST_SEGMENTS = 1 << 21, 1 << 12
INDEX = "segment_filters"


def segments_for(n_rows: int) -> int:
    return min(MOST_SEGMENTS, max(1, -(-n_rows // SEGMENT_ROWS)))


def segment_of(key: str, segments: int) -> Column:
    """The segment of a key; rows without one are in the first."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit("segment"), F.col(key)), F.lit(segments)), F.lit(0)).cast("int")


def _store(change: Change, name: str, rows: DataFrame, key: str, segments: int, blocks: int | None) -> Part:
    """Write rows to a segmented folder and their keys' filters to the index."""
    part = Part(change.store.new_folder(name), segmented=True)
    placed = fit(rows, change.schemas[name]).withColumn(SEGMENT, segment_of(key, segments))
    placed.hint("rebalance", SEGMENT).write.partitionBy(SEGMENT).parquet(f"{change.root}/{part.path}")
    keys = change.spark.read.schema(segmented(change.schemas[name])).parquet(f"{change.root}/{part.path}")
    keys = keys.select(key, SEGMENT).distinct()
    if blocks is None:
        most = keys.groupBy(SEGMENT).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        blocks = keyfilter.blocks_for(most or 1)
    filters = keyfilter.build(keys, key, blocks, (SEGMENT,)).select(
        F.lit(part.path).alias("path"),
        F.lit(segments).cast("int").alias("segments"),
        F.lit(blocks).cast("long").alias("blocks"),
        F.col(SEGMENT).alias("segment"),
        "block",
        "bits",
    )
    change.append(INDEX, filters)
    return part


def replace_segmented(change: Change, name: str, rows: DataFrame, key: str, segments: int) -> None:
    """Reset and reload a table by segments of ``key``."""
    _forget(change, change.parts(name))
    change.tables[name] = (_store(change, name, rows, key, segments, None),)


def _forget(change: Change, parts: tuple[Part, ...]) -> None:
    """Leave the filters of parts that are in no table any more out of the index."""
    gone = [p.path for p in parts if p.segmented]
    if gone:
        change.replace(INDEX, change.read(INDEX).where(~F.col("path").isin(gone)))


def _touched(index: DataFrame, part: Part, gone: DataFrame, key: str) -> tuple[int, int, int, list[int]]:
    """Number of segments a part was made with, of blocks, of segments in it, and the segments that may
    hold one of the keys: one join on segment and block, of keys and filter rows."""
    own = index.where((F.col("path") == part.path) & ~F.col("segment").isin(*part.without))
    first = own.select("segments", "blocks").first()
    if first is None:  # no key at all in it
        return 1, 1, 0, []
    present = own.select("segment").distinct().count()
    filters = own.select(F.struct("segment", "block").alias("block"), "segment", "bits")
    placed = gone.withColumn("_at", segment_of(key, first.segments))
    asked = keyfilter.may_meet(placed, key, filters, first.blocks, "segment", within="_at")
    return first.segments, first.blocks, present, sorted(r.segment for r in asked.toLocalIterator())


def delete_keys(change: Change, name: str, gone: DataFrame, key: str) -> dict[str, int]:
    """Delete the rows whose key is in ``gone``. Plain folders are written anew; of segmented ones the
    segments that may hold such a key. Returns how many segments were rewritten, and taken over."""
    index, parts, told = change.read(INDEX) if INDEX in change.schemas else None, [], {"rewritten": 0, "kept": 0}
    plain = tuple(p for p in change.parts(name) if not p.segmented)
    if plain:
        parts.append(change.write(name, without_parent(change.read_parts(name, plain), gone, key)))
    keys = materialize(gone.select(key).distinct(), "gone") if index is not None else gone
    for part in change.parts(name):
        if not part.segmented:
            continue
        segments, blocks, present, touched = _touched(index, part, keys, key)
        told["rewritten"] += len(touched)
        told["kept"] += present - len(touched)
        if not touched:
            parts.append(part)
            continue
        rows = change.spark.read.schema(segmented(change.schemas[name])).parquet(f"{change.root}/{part.path}")
        left = without_parent(rows.where(F.col(SEGMENT).isin(*touched)), keys, key)
        parts.append(changed(part, without=tuple(sorted({*part.without, *touched}))))
        parts.append(_store(change, name, left.drop(SEGMENT), key, segments, blocks))
    change.tables[name] = tuple(parts)
    return told
