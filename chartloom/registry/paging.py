"""Page chains over pages of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import paging as ops
from chartloom.registry import roles
from chartloom.session import materialize

BUDGET = 1_500
TYPES = ["click", "view", "error", "signup", "purchase"]


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type, pages of 50 ids: readings below 80 are the entries; a page whose total is
    high has no next link."""
    events = roles.table(spark, sf_dir, "events")
    page = F.expr("event_id div 50")
    found = events.groupBy(F.col("event_type").alias("resource_type"), page.alias("page")).agg(
        F.count_if(F.col("value") < 80).alias("n_entries"),
        F.when(F.max("value") < 230, F.concat(F.lit("?page="), page + 1)).alias("next_url"),
    )
    return materialize(found, "pages")


def page_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.running_records(pages(spark, sf_dir)).select("resource_type", "page", "collected")


def page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ops.within_budget(pages(spark, sf_dir), BUDGET)
    return kept.select("resource_type", "page", "n_entries", "collected")


def page_chain_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ops.until_stop(pages(spark, sf_dir), TYPES)
    return kept.select("resource_type", "page", "n_entries", "next_url")


QUERIES = {
    "page_running_total": page_running_total,
    "page_budget": page_budget,
    "page_chain_stop": page_chain_stop,
}
_PAGES = """
WITH pages AS (
  SELECT event_type AS resource_type, event_id // 50 AS page,
         count(*) FILTER (WHERE value < 80) AS n_entries,
         CASE WHEN max(value) < 230 THEN '?page=' || CAST(event_id // 50 + 1 AS VARCHAR) END AS next_url
  FROM events GROUP BY event_type, event_id // 50)"""
_RUNNING = f"""{_PAGES}, running AS (
  SELECT *, CAST(sum(n_entries) OVER (PARTITION BY resource_type ORDER BY page
                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS collected FROM pages)"""
SQL = {
    "page_running_total": f"{_RUNNING} SELECT resource_type, page, collected FROM running",
    "page_budget": f"""{_RUNNING}
SELECT resource_type, page, n_entries, collected FROM running WHERE collected - n_entries < {BUDGET}""",
    "page_chain_stop": f"""{_PAGES}, seen AS (
  SELECT *, min(n_entries) OVER (PARTITION BY resource_type ORDER BY page
              ROWS UNBOUNDED PRECEDING) AS fewest,
         max(CASE WHEN next_url IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY resource_type
              ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended
  FROM pages)
SELECT resource_type, page, n_entries, next_url FROM seen
WHERE fewest > 0 AND coalesce(ended, 0) = 0""",
}
