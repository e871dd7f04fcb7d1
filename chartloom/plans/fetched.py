"""Page chains: what a fetch with a record budget keeps and lands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators import paging
from chartloom.session import materialize
from chartloom.sinks.files import land_pages
from chartloom.sources.bundles import parse_pages

def chain_report(
    pages: DataFrame, total: int | None = None, types: list[str] | None = None
) -> DataFrame:
    """Pages a fetch of ``total`` records per type keeps (without a total, of all), with the running
    number of records; of all types in the data, or of the given ones.

    The page table, one short row per bundle, is stored first, so the bundles are read once.
    """
    chain = paging.until_stop(materialize(pages, "pages"), types)
    return paging.within_budget(chain, total)


def land_chain(
    pages: DataFrame, path: str, total: int | None = None, types: list[str] | None = None
) -> DataFrame:
    """Land the kept ones of raw pages (``resource_type, page, payload``); pages without a number
    belong to no chain and are all landed. Returns resource_type, landed and left_out: how many.

    Kept pages are the first ones of their type, so payloads meet one row per type and are not
    shuffled.
    """
    source = F.col("src_file")
    lone = F.col("page").isNull()
    chained = pages.filter(~lone)
    table = paging.page_table(
        parse_pages(chained), paging.type_from_file(source), paging.page_from_file(source)
    )
    report = chain_report(table, total, types)
    last = materialize(
        report.groupBy(F.col("resource_type").alias("_type")).agg(F.max("page").alias("_last")),
        "last",
    )
    judged = pages.join(last, F.lower("resource_type") == F.col("_type"), "left").withColumn(
        "_kept", lone | F.coalesce(F.col("page") <= F.col("_last"), F.lit(False))
    )
    land_pages(judged.filter("_kept"), path)
    return judged.groupBy(F.lower("resource_type").alias("resource_type")).agg(
        F.count_if("_kept").alias("landed"), F.count_if(~F.col("_kept")).alias("left_out")
    )
