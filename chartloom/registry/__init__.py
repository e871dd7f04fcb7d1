"""Every operator as a query over the given tables, next to the same question in plain SQL."""

from __future__ import annotations

from chartloom.registry import batches, chains, conform, integrity, jobs, paging, reports, scan, shapes, timeline

QUERIES: dict = {}
SQL: dict = {}
for _module in (timeline, reports, scan, conform, integrity, paging, chains, jobs, batches, shapes):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
