"""Incremental staging: each bundle file is read once, however often the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chartloom.plans.staging import Staged, routed, split_routes
from chartloom.sources.bundles import as_bundles, text_lines, with_source


def stage_new(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    names: str = "*",
    multi_line: bool = True,
) -> StreamingQuery:
    """Stage what arrived in ``folder`` since the last run, then stop.

    A batch that is run again after a failure overwrites its own folder, so nothing is doubled.
    """
    scan = (
        spark.readStream.format("text")
        .option("wholetext", multi_line)
        .option("pathGlobFilter", names)
        .load(folder)
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        flat = routed(as_bundles(batch))
        flat.write.mode("overwrite").partitionBy("route").parquet(f"{out}/batch={batch_id}")

    return (
        with_source(text_lines(scan, multi_line))
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def staged(spark: SparkSession, out: str) -> Staged:
    """All records staged so far."""
    return split_routes(spark.read.parquet(out))
