"""Bloom filters of keys as tables, made, united and asked by built-in functions.

A filter has blocks of as many bits as the bitmap functions hold, one row each; a key has one block and
four bits in it, so asking is one join on the block, and a filter may be as large as a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15
BITS_PER_KEY, PROBES = 16, 4


def blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))


def _block(key: str, blocks: int | Column) -> Column:
    n = F.lit(blocks) if isinstance(blocks, int) else blocks
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key)), n.cast("bigint"))


def _places(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BLOCK_BITS)).cast("bigint") for i in range(PROBES)]


def build(keys: DataFrame, key: str, blocks: int, by: tuple[str, ...] = ()) -> DataFrame:
    """``by…, block, bits`` of all keys that are not NULL; one filter for each value of ``by``."""
    placed = keys.where(F.col(key).isNotNull()).select(
        *by, _block(key, blocks).alias("block"), F.explode(F.array(*_places(key))).alias("place")
    )
    return placed.groupBy(*by, "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def unite(filters: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per block of filters made at different times, with the same number of blocks."""
    return filters.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _has(bits: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2 == 1


def ask(rows: DataFrame, key: str, filters: DataFrame, blocks: int, mark: str) -> DataFrame:
    """``rows`` with whether their key may be in the filter: never false for one that is. A NULL key
    is in no filter."""
    f = filters.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    found = reduce(Column.__and__, [_has("_bits", place) for place in _places(key)])
    asked = rows.withColumn("_asked", _block(key, blocks)).join(f, F.col("_asked") == F.col("_block"), "left")
    may = F.col(key).isNotNull() & F.coalesce(found, F.lit(False))
    return asked.withColumn(mark, may).drop("_asked", "_block", "_bits")


def may_meet(keys: DataFrame, key: str, filters: DataFrame, blocks: int, by: str, within: str) -> DataFrame:
    """Values of ``by`` whose filter may hold one of the keys. A key is asked in one filter only, that
    of its column ``within``; the filters' ``block`` is (that, block)."""
    found = reduce(Column.__and__, [_has("bits", place) for place in _places(key)])
    asked = keys.where(F.col(key).isNotNull()).select(
        key, F.struct(F.col(within).alias("segment"), _block(key, blocks).alias("block")).alias("block")
    )
    return asked.join(filters, "block").where(found).select(by).distinct()
