"""Page chains by their links alone: no page number, any order of files.

A page has a ``url`` and names the ``next_url`` that a fetch asks for after it. Pages are ranked by
pointer doubling: every page points to an ancestor and knows how far away it is; each round it takes over
the ancestor's pointer and adds the distances, so a chain of n pages takes log2(n) rounds, each of them one
join of the pages that have not reached a head with all. Nothing is followed page by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.paging import next_url, within_budget
from chartloom.schemas import LINKS
from chartloom.session import materialize

#: How a chain ends: no next link, one that no page has, a page of another chain, or its own first page.
END, MISSING, JOINS, CYCLE = "end", "missing", "joins", "cycle"


def self_url(link: Column) -> Column:
    """URL of the first ``self`` link in raw link text, NULL without one."""
    links = F.from_json(link, LINKS)
    return F.get(F.filter(links, lambda x: x["relation"] == "self"), F.lit(0)).getField("url")


def linked_pages(bundles: DataFrame, *keep: str) -> DataFrame:
    """One row per page: ``url, next_url, n_entries`` and the columns to keep."""
    return bundles.select(
        *keep,
        self_url(F.col("link")).alias("url"),
        next_url(F.col("link")).alias("next_url"),
        F.coalesce(F.array_size("entry"), F.lit(0)).cast("bigint").alias("n_entries"),
    )


def _one_per_url(pages: DataFrame) -> DataFrame:
    """(url, next_url) of the pages that have a url. Of pages with one url the one with the least next
    link counts, and one without any only if none has one."""
    return pages.where("url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("next_url"))


def ranked(pages: DataFrame) -> DataFrame:
    """``url, next_url, head, place`` of each different url: the first page of its chain and how many
    pages come before it there. ``head`` is NULL on a cycle.

    Of several pages with the same next link the least url goes before it; the others' chains end.
    """
    links = materialize(_one_per_url(pages), "links")
    before = links.where("next_url IS NOT NULL").groupBy(F.col("next_url").alias("url")).agg(
        F.min("url").alias("before")
    )
    state = links.select("url").join(before, "url", "left").select(
        "url",
        F.coalesce("before", "url").alias("ancestor"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("bigint").alias("place"),
        F.col("before").isNull().alias("done"),
    )
    state = materialize(state, "ranks")
    for _ in range(links.count().bit_length()):
        going = state.where(~F.col("done"))
        if going.isEmpty():
            break
        on = state.select(
            F.col("url").alias("ancestor"),
            F.col("ancestor").alias("further"),
            F.col("place").alias("steps"),
            F.col("done").alias("arrived"),
        )
        moved = going.join(on, "ancestor").select(
            "url", F.col("further").alias("ancestor"), (F.col("place") + F.col("steps")).alias("place"),
            F.col("arrived").alias("done"),
        )
        state = materialize(state.where("done").unionByName(moved), "ranks")
    place = state.select(
        "url", F.when(F.col("done"), F.col("ancestor")).alias("head"), F.when(F.col("done"), F.col("place")).alias("place")
    )
    return links.join(place, "url")


def chains(places: DataFrame) -> DataFrame:
    """One row per chain of ``ranked`` pages: ``head, n_pages, ending, last_url``; cycles have no head
    and are one row together, with the number of their pages."""
    after = places.select(
        F.col("url").alias("next_url"), F.col("head").alias("next_head"), F.col("place").alias("next_place"),
        F.lit(True).alias("there"),
    )
    follows = F.col("there") & F.col("next_head").eqNullSafe(F.col("head")) & (F.col("next_place") == F.col("place") + 1)
    last = places.where("head IS NOT NULL").join(after, "next_url", "left").where(~F.coalesce(follows, F.lit(False)))
    ending = F.when(F.col("next_url").isNull(), END).when(F.col("there"), JOINS).otherwise(MISSING)
    last = last.select("head", (F.col("place") + 1).alias("n_pages"), ending.alias("ending"), F.col("url").alias("last_url"))
    none = F.lit(None).cast("string")
    round_ = places.where("head IS NULL").agg(F.count("*").alias("n_pages")).where("n_pages > 0")
    return last.unionByName(
        round_.select(none.alias("head"), "n_pages", F.lit(CYCLE).alias("ending"), none.alias("last_url"))
    )


def chain_by_links(pages: DataFrame, total: int | None = None, heads: list[str] | None = None) -> DataFrame:
    """The pages a fetch keeps that starts at each head (or the given ones): those before its chain's
    first empty page, until ``total`` records are there, the page that crosses kept whole; with
    ``head, place`` and the records so far, ``collected``.

    ``pages``: ``url, next_url, n_entries`` and any other columns. Pages on a cycle have no first
    page and are in no chain; of repeated urls the one with most entries counts.
    """
    stored = materialize(pages, "pages")
    places = materialize(ranked(stored), "places").where("head IS NOT NULL").drop("next_url")
    if heads is not None:
        places = places.where(F.col("head").isin(heads))
    sized = stored.where("url IS NOT NULL").groupBy("url").agg(F.max("n_entries").alias("n_entries"))
    chained = materialize(places.join(sized, "url"), "chained")
    empty = chained.where("n_entries = 0").groupBy("head").agg(F.min("place").alias("stop"))
    kept = chained.join(empty, "head", "left").where("stop IS NULL OR place < stop").drop("stop")
    kept = materialize(kept.withColumnsRenamed({"head": "resource_type", "place": "page"}), "kept")
    return within_budget(kept, total).withColumnsRenamed({"resource_type": "head", "page": "place"})
