"""Staging CSV files."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.text import na_to_null
from chartloom.functions.typed import to_number
from chartloom.session import materialize
from chartloom.sources.bundles import with_source

BAD_ROW = "BAD_CSV_ROW"


def read_staging(
    spark: SparkSession, path: str, numeric: tuple[str, ...] = (), multi_line: bool = True
) -> DataFrame:
    """Columns by header name, all text; NA tokens become NULL, ``numeric`` columns doubles.

    Adds the source position for keep-first rules. A file whose header differs from the others', also
    in order, stops the job, and so does a row with too many or too few values, where they would else
    lose or shift values unseen; for that, whole rows are parsed. Not seen
    is a quote left open in a last column, which then takes in the lines up to the next quote.
    ``multi_line`` allows line breaks within quoted values at one task per file; turn it off for
    files that have none, to split them.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("multiLine", multi_line)
    )
    named = reader.csv(path).schema
    raw = reader.schema(named).option("enforceSchema", False).csv(path)
    values = [na_to_null(F.col(f"`{c}`")) for c in raw.columns]
    return with_source(raw).select(
        *[
            (to_number(v) if c in numeric else v).alias(c)
            for c, v in zip(raw.columns, values)
        ],
        "src_file",
        "src_path",
        "src_offset",
        F.monotonically_increasing_id().alias("src_row"),
    )


#: Distinct headers that one folder may have; more are not headers but data.
MOST_HEADERS = 200
_BAD = "_bad_row"


@dataclass
class Staging:
    """Rows by name, and the rows that do not fit their file's header."""

    rows: DataFrame
    rejects: DataFrame


def _path() -> Column:
    return F.col("_metadata.file_path")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``header`` of each file: its first line, without a byte order mark."""
    lines = spark.read.text(path).select(
        _path().alias("path"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    first = lines.where("start = 0").groupBy("path").agg(F.min(F.struct("at", "value"))["value"].alias("header"))
    return first.withColumn("header", F.regexp_replace("header", "^﻿", ""))


def _names(spark: SparkSession, header: str) -> list[str]:
    """Column names of a header line."""
    options = {"escape": '"', "maxColumns": "20000"}
    width = header.count(",") + 1
    kinds = ", ".join(f"c{i} STRING" for i in range(width))
    found = spark.range(1).select(F.from_csv(F.lit(header), kinds, options).alias("r")).select("r.*").first()
    given = [i for i, n in enumerate(found) if n is not None]
    names = [n if n is not None else f"_c{i}" for i, n in enumerate(found[: max(given, default=-1) + 1])]
    if len(set(names)) < len(names):
        raise ValueError(f"a column comes twice in the header {header!r}")
    return names


def _one_header(spark, path: str, names: list[str], files: DataFrame, others: int, multi_line: bool) -> DataFrame:
    """All rows of the files with this header, parsed once and stored; ``_bad_row`` has the text of those
    that do not fit it."""
    kinds = ", ".join(f"`{n}` STRING" for n in [*names, _BAD])
    raw = (
        spark.read.schema(kinds)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .csv(path)
    ).withColumns({"_file": _path(), "_start": F.col("_metadata.file_block_start"), "_name": F.col("_metadata.file_name")})
    if others:
        raw = raw.join(files.select(F.col("path").alias("_own")), F.col("_file") == F.col("_own"), "left_semi")
    raw = raw.withColumns({"_row": F.monotonically_increasing_id(), "_bad": F.col(_BAD).isNotNull()})
    return materialize(raw, "staging", ["_bad"])


def read_staging_any(
    spark: SparkSession, path: str, numeric: tuple[str, ...] = (), multi_line: bool = True
) -> Staging:
    """As ``read_staging``, for files that need not have one header: each distinct header is one scan,
    columns are brought together by name, and one that a file does not have is NULL there. Rows with too many
    or too few values are not lost and do not stop the job: they become rejects, with their file and text.

    A header is the first line of its file; there may be ``MOST_HEADERS`` different ones.
    """
    found = materialize(headers(spark, path), "headers")
    distinct = [r.header for r in found.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(distinct) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers below {path}")
    if not distinct:
        raise ValueError(f"no file with a header below {path}")
    named = {h: _names(spark, h) for h in sorted(distinct)}
    columns = list(dict.fromkeys(n for names in named.values() for n in names))
    rows, bad = [], []
    for header, names in named.items():
        raw = _one_header(spark, path, names, found.where(F.col("header") == header), len(distinct) - 1, multi_line)
        values = {n: na_to_null(F.col(f"`{n}`")) for n in names}
        kept = []
        for c in columns:
            kind = "double" if c in numeric else "string"
            value = values.get(c, F.lit(None).cast("string"))
            kept.append((to_number(value) if c in numeric else value).cast(kind).alias(c))
        source = [F.col("_name").alias("src_file"), F.col("_file").alias("src_path"), F.col("_start").alias("src_offset")]
        rows.append(raw.where("NOT _bad").select(*kept, *source, F.col("_row").alias("src_row")))
        bad.append(raw.where("_bad").select(F.col("_name").alias("file_name"), F.col(_BAD).alias("message")))
    none = F.lit(None).cast("string")
    rejects = reduce(DataFrame.unionByName, bad).select(
        F.lit("WARNING").alias("severity"),
        F.lit(BAD_ROW).alias("rule"),
        none.alias("resource_type"),
        none.alias("resource_id"),
        "file_name",
        "message",
    )
    return Staging(reduce(DataFrame.unionByName, rows), rejects)
