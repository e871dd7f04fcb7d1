"""Page chains by links alone, over the landed bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import chains as ops
from chartloom.registry.landing import bundles
from chartloom.session import materialize

BUDGET = 450


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages in no order. Every seventh page of observations has lost its next link, so there are
    many chains; the last page of patients leads back to the fourth."""
    found = ops.linked_pages(bundles(spark, sf_dir))
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    cut = F.col("url").contains("/Observation?") & (number % 7 == 6)
    back = F.col("url").contains("/Patient?") & F.col("next_url").isNull()
    following = F.when(~cut, F.when(back, F.regexp_replace("url", r"\d+$", "3")).otherwise(F.col("next_url")))
    return found.withColumn("next_url", following).orderBy(F.xxhash64("url"))


def chain_by_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fetch with a budget keeps of each chain."""
    kept = ops.chain_by_links(_pages(spark, sf_dir), BUDGET)
    return kept.select("url", "head", "place", "n_entries", "collected")


def chain_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chain with its length and how it ends."""
    return ops.chains(materialize(ops.ranked(_pages(spark, sf_dir)), "places"))


QUERIES = {"chain_by_links": chain_by_links, "chain_ends": chain_ends}
_WALKED = """
WITH RECURSIVE filled AS (
  SELECT 'Observation' AS kind, event_id // 100 AS page, count(*) AS n FROM events GROUP BY 2
  UNION ALL SELECT 'Patient', c_custkey // 100, count(*) FROM customer GROUP BY 2),
numbered AS (
  SELECT * FROM filled
  UNION ALL SELECT kind, max(page) + 1, 0 FROM filled GROUP BY kind
  UNION ALL SELECT kind, max(page) + 2, 0 FROM filled GROUP BY kind),
linked AS (
  SELECT kind, page, n, CASE
    WHEN kind = 'Observation' AND page % 7 = 6 THEN NULL
    WHEN page < max(page) OVER (PARTITION BY kind) THEN page + 1
    WHEN kind = 'Patient' THEN 3 END AS next_page
  FROM numbered),
link AS (
  SELECT 'https://records.example/' || kind || '?page=' || CAST(page AS VARCHAR) AS url, n AS n_entries,
         'https://records.example/' || kind || '?page=' || CAST(next_page AS VARCHAR) AS next_url
  FROM linked),
before AS (SELECT next_url AS url, min(url) AS prior FROM link WHERE next_url IS NOT NULL GROUP BY next_url),
walked AS (
  SELECT url, url AS head, CAST(0 AS BIGINT) AS place, n_entries, next_url
  FROM link WHERE url NOT IN (SELECT url FROM before)
  UNION ALL
  SELECT l.url, w.head, w.place + 1, l.n_entries, l.next_url
  FROM walked w JOIN link l ON l.url = w.next_url JOIN before b ON b.url = l.url AND b.prior = w.url)"""
SQL = {
    "chain_by_links": f"""{_WALKED}, stops AS (SELECT head, min(place) AS stop FROM walked WHERE n_entries = 0 GROUP BY head),
running AS (
  SELECT url, w.head, place, n_entries,
         CAST(sum(n_entries) OVER (PARTITION BY w.head ORDER BY place) AS BIGINT) AS collected
  FROM walked w LEFT JOIN stops s ON s.head = w.head WHERE stop IS NULL OR place < stop)
SELECT * FROM running WHERE collected - n_entries < {BUDGET}""",
    "chain_ends": f"""{_WALKED}, last_page AS (
  SELECT head, max(place) + 1 AS n_pages, arg_max(url, place) AS last_url, arg_max(coalesce(next_url, ''), place) AS next_url
  FROM walked GROUP BY head)
SELECT head, n_pages, CASE WHEN next_url = '' THEN 'end'
       WHEN next_url IN (SELECT url FROM link) THEN 'joins' ELSE 'missing' END AS ending, last_url FROM last_page
UNION ALL SELECT NULL, count(*), 'cycle', NULL FROM link WHERE url NOT IN (SELECT url FROM walked) HAVING count(*) > 0""",
}
