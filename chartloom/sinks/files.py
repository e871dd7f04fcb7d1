"""File sinks: staging CSV, raw bundle landing, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import NA_EXPORT
from chartloom.schemas import QUARANTINE


def write_staging(df: DataFrame, path: str, max_rows_per_file: int = 1_000_000) -> None:
    """CSV with header; missing values as ``N/A``, text byte for byte, files of bounded size."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", NA_EXPORT)
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", max_rows_per_file)
        .csv(path)
    )


def land_pages(pages: DataFrame, path: str) -> None:
    """Land raw bundles unchanged: ``resource_type`` (lower case) as partition, page, payload."""
    (
        pages.select(
            F.lower("resource_type").alias("resource_type"),
            F.col("page").cast("bigint").alias("page"),
            F.col("payload").cast("string").alias("payload"),
        )
        .write.mode("overwrite")
        .partitionBy("resource_type")
        .parquet(path)
    )


def land_lines(pages: DataFrame, path: str) -> None:
    """Land raw bundles as text, one per line, by resource type; splittable by the JSON reader.

    Line breaks of pretty-printed JSON become blanks; within JSON strings there are none.
    """
    line = F.translate("payload", "\r\n", "  ").alias("payload")
    (
        pages.select(F.lower("resource_type").alias("resource_type"), line)
        .write.mode("overwrite")
        .partitionBy("resource_type")
        .text(path)
    )


def log_rejects(rejects: DataFrame, path: str) -> None:
    """Append rejects with the time of this run."""
    stamped = rejects.withColumn("logged_at", F.current_timestamp())
    stamped.select(QUARANTINE.fieldNames()).write.mode("append").parquet(path)
