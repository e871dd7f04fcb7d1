"""Positions and running totals over whole tables, without a single ordered task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.session import materialize


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Add 0, 1, 2, … in ``order``, which should identify a row.

    Range partitions are sorted and numbered locally, and stored with those numbers, so that the
    offsets and the rows come from the same partitioning even when tasks are run again. The
    offsets table has one row per range partition and is the only thing broadcast.
    """
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_local": local})
    )
    stored = materialize(ranged, "ranged")
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_part", "_local", "_start")
    )


def running_total(
    df: DataFrame, group: str, order: str, value: str, name: str, block_bits: int = 16
) -> DataFrame:
    """Running sum of ``value`` per ``group`` by the integer ``order``, unique in its group
    and never NULL.

    A group may hold most rows, so it is cut into blocks of 2^``block_bits`` consecutive ``order``
    values: sums within blocks run in parallel, and only block totals are summed in sequence.
    ``df`` is read twice and best a stored table.
    """
    blocked = df.withColumn("_block", F.shiftright(order, block_bits))
    earlier = W.partitionBy(group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    starts = (
        blocked.groupBy(group, "_block")
        .agg(F.sum(value).alias("_total"))
        .select(group, "_block", before.alias("_start"))
    )
    so_far = W.partitionBy(group, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        blocked.withColumn("_sum", F.sum(value).over(so_far))
        .join(starts, [group, "_block"])
        .withColumn(name, F.col("_start") + F.col("_sum"))
        .drop("_block", "_sum", "_start")
    )
