"""Bundle files as a DataFrame with one row per bundle."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from chartloom.schemas import BUNDLE, ENTRY, LOOSE_BUNDLE
from chartloom.sources import listing

_EMPTY = (
    f"src_file STRING, src_path STRING, src_offset BIGINT, src_row BIGINT, bundle_id STRING, entry ARRAY<{ENTRY}>, "
    "link STRING, corrupt BOOLEAN"
)
#: Type of page files whose name does not tell.
UNNAMED = "unnamed"
_PAGES = "resource_type STRING, page BIGINT, payload STRING"
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "misfit",
    "allowSingleQuotes": "false",
}


def _load(reader: DataFrameReader, paths: list[str], names: str | None) -> DataFrame | None:
    """The files of those paths that exist; one listing unless a path is missing."""
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    try:
        return reader.load(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    if len(paths) == 1:
        return None
    found = [p for p in paths if _load(reader, [p], names) is not None]
    return reader.load(found) if found else None


def is_missing(spark: SparkSession, *paths: str, names: str | None = None) -> bool:
    """Whether there is no file with content at all."""
    raw = _load(spark.read.format("text"), list(paths), names)
    return raw is None or raw.isEmpty()


def _plain(name: Column) -> Column:
    """A file name without URL escapes."""
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), decoded).otherwise(name)


def with_source(raw: DataFrame) -> DataFrame:
    """Add the file name, the whole path, which tells files of one name apart, and the offset of
    the split to a file scan."""
    return raw.select(
        _plain(F.col("_metadata.file_name")).alias("src_file"),
        _plain(F.col("_metadata.file_path")).alias("src_path"),
        F.col("_metadata.file_block_start").alias("src_offset"),
        *raw.columns,
    )


def _parsed(text: Column, bundle: str, how: str) -> Column:
    """Columns of one parse. It runs inside a generator, so that it runs once, however often its
    columns are used, and no filter is pushed below it that would parse again."""
    schema = f"b ARRAY<{bundle}>, mark STRING, misfit STRING"
    found = F.inline(F.array(F.from_json(text, schema, _STRICT)))
    return found.alias(f"{how}_b", f"{how}_mark", f"{how}_misfit")


def as_bundles(texts: DataFrame) -> DataFrame:
    """Bundles from their text: ``src_file``, ``src_path``, ``src_offset``, ``value``, one each.

    Fields that may be lists or not are raw text in the schema, so nearly all bundles fit it and are
    parsed once. Those that do not are parsed again entry by entry: a mistyped field is then NULL by
    itself, and only bad JSON is corrupt. The text is
    parsed as the one element of an array with a mark behind it, since anything after the end of a
    bundle, such as a second bundle, would go unnoticed otherwise.
    """
    mark = uuid.uuid4().hex
    wrapped = F.concat(F.lit('{"b":['), F.col("value"), F.lit(f'],"mark":"{mark}"}}'))
    lineage = ["src_file", "src_path", "src_offset", "src_row"]
    found = (
        texts.withColumn("src_row", F.monotonically_increasing_id())
        .select(*lineage, _parsed(wrapped, BUNDLE, "tight"))
        .select("*", _parsed(F.col("tight_misfit"), LOOSE_BUNDLE, "loose"))
    )
    fits = F.col("tight_misfit").isNull()
    tight, loose = F.get("tight_b", F.lit(0)), F.get("loose_b", F.lit(0))
    one_by_one = F.transform(loose["entry"], lambda e: F.from_json(e, ENTRY, _STRICT))

    def whole(how: str) -> Column:
        one = (F.array_size(f"{how}_b") == 1) & F.get(f"{how}_b", F.lit(0)).isNotNull()
        end = F.col(f"{how}_misfit").isNull() & (F.col(f"{how}_mark") == mark)
        return F.coalesce(one & end, F.lit(False))

    good = whole("tight") | whole("loose")

    def when_good(tight_value: Column, loose_value: Column) -> Column:
        return F.when(good, F.when(fits, tight_value).otherwise(loose_value))

    return found.select(
        *lineage,
        when_good(tight["id"], loose["id"]).alias("bundle_id"),
        when_good(tight["entry"], one_by_one).alias("entry"),
        when_good(tight["link"], loose["link"]).alias("link"),
        (~good).alias("corrupt"),
    )


def text_lines(raw: DataFrame, multi_line: bool) -> DataFrame:
    """Rows of a text scan that hold a bundle: all files, or all lines that are not blank."""
    return raw if multi_line else raw.filter(F.btrim("value") != "")


def read_bundles(
    spark: SparkSession, *paths: str, names: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Scan bundle files: ``bundle_id, entry, link, corrupt`` and the source position.

    ``paths`` are folders, files or patterns; paths without files give no rows. Of many files in a
    folder choose by ``names``, such as ``patient_page_*.json``: the folder is then listed at once,
    where a pattern makes every file a path of its own.

    ``multi_line`` reads one pretty-printed bundle per file, which one task must hold; without it
    every line is a bundle and large files are split. Bad JSON gives one ``corrupt`` row and leaves
    its neighbours alone.
    """
    raw = _load(spark.read.format("text").option("wholetext", multi_line), list(paths), names)
    if raw is None:
        return spark.createDataFrame([], _EMPTY)
    return as_bundles(with_source(text_lines(raw, multi_line)))


def read_pages(spark: SparkSession, *paths: str, names: str | None = None) -> DataFrame:
    """Page files as raw text, with type and page number from names such as
    ``observation_page_12.json``; files of other names have the type ``UNNAMED`` and no number."""
    raw = _load(spark.read.format("text").option("wholetext", True), list(paths), names)
    if raw is None:
        return spark.createDataFrame([], _PAGES)
    parts = r"^(.+)_page_(\d+)\.json$"
    name = _plain(F.col("_metadata.file_name"))
    named = name.rlike(parts)
    return raw.select(
        F.when(named, F.regexp_extract(name, parts, 1)).otherwise(UNNAMED).alias("resource_type"),
        F.when(named, F.regexp_extract(name, parts, 2).cast("bigint")).alias("page"),
        F.col("value").alias("payload"),
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Bundles of raw ``payload`` text per ``resource_type`` and ``page``, which name the source
    file: ``observation_page_12.json``."""
    kind = F.lower("resource_type")
    named = F.format_string("%s_page_%d.json", kind, "page")
    name = F.when(F.col("page").isNull(), F.concat(kind, F.lit(".json"))).otherwise(named)
    start = F.lit(0).cast("bigint").alias("src_offset")
    return as_bundles(
        pages.select(name.alias("src_file"), name.alias("src_path"), start, F.col("payload").alias("value"))
    )


def read_landed(spark: SparkSession, path: str, resource_type: str | None = None) -> DataFrame:
    """Bundles of a landed table of pages; those of one type without touching the others."""
    landed = spark.read.schema(_PAGES).parquet(path)
    if resource_type is not None:
        landed = landed.filter(F.col("resource_type") == resource_type.lower())
    return parse_pages(landed)


def empty_files(spark: SparkSession, *paths: str, names: str | None = None) -> DataFrame:
    """Name and path of files of no bytes, which a scan passes over. No content is read, and no
    listing passes through the driver: see ``sources.listing``."""
    found = listing.files(spark, *paths).where("size = 0").select("src_file", "src_path")
    if names is not None:
        found = found.where(F.col("src_file").rlike(listing.pattern(names)))
    return found
