"""Page chains: links, running totals, record budget and stop rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.ordinal import running_total
from chartloom.schemas import LINKS


def next_url(link: Column) -> Column:
    """URL of the first ``next`` link in raw link text, NULL without one."""
    links = F.from_json(link, LINKS)
    return F.get(F.filter(links, lambda x: x["relation"] == "next"), F.lit(0)).getField("url")


def page_table(bundles: DataFrame, resource_type: Column, page: Column) -> DataFrame:
    """One row per page; type and page number come from where the caller keeps them."""
    return bundles.select(
        resource_type.alias("resource_type"),
        page.cast("bigint").alias("page"),
        F.coalesce(F.array_size("entry"), F.lit(0)).cast("bigint").alias("n_entries"),
        next_url(F.col("link")).alias("next_url"),
    )


def page_from_file(file_name: Column) -> Column:
    """Number in names such as ``observation_page_12.json``."""
    return F.nullif(F.regexp_extract(file_name, r"_page_(\d+)", 1), F.lit("")).cast("bigint")


def type_from_file(file_name: Column) -> Column:
    return F.substring_index(file_name, "_page_", 1)


def running_records(pages: DataFrame) -> DataFrame:
    """Records so far per resource type, up to and including each page."""
    return running_total(pages, "resource_type", "page", "n_entries", "collected")


def within_budget(pages: DataFrame, total: int | None) -> DataFrame:
    """Pages fetched until ``total`` records are there; the page that crosses is kept whole. Without
    a ``total`` all pages."""
    counted = running_records(pages)
    if total is None:
        return counted
    return counted.filter(F.col("collected") - F.col("n_entries") < total)


def until_stop(pages: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Pages before the first empty page and up to the first without a next link, of all types or
    of the given ones. The stop pages are one row per type."""
    asked = pages if types is None else pages.filter(F.col("resource_type").isin(types))
    stops = asked.groupBy(F.col("resource_type").alias("_type")).agg(
        F.min(F.when(F.col("n_entries") == 0, F.col("page"))).alias("_empty"),
        F.min(F.when(F.col("next_url").isNull(), F.col("page"))).alias("_last"),
    )
    return (
        asked.join(stops, F.col("resource_type") == F.col("_type"))
        .filter(
            F.coalesce(F.col("page") < F.col("_empty"), F.lit(True))
            & F.coalesce(F.col("page") <= F.col("_last"), F.lit(True))
        )
        .drop("_type", "_empty", "_last")
    )
