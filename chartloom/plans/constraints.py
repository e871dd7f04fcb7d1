"""Violations of the constraints that stored tables cannot enforce by themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.integrity import duplicate_keys, missing_values, without_parent
from chartloom.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS
from chartloom.sinks.tables import Tables


def violations(tables: Tables) -> DataFrame:
    """``table_name, column_name, rule, value, n_rows``; a NULL key breaks neither key rule.

    Every rule counts before it lists, so a value that breaks a rule a million times is one row.
    """

    def listed(table: str, column: str, rule: str, counts: DataFrame) -> DataFrame:
        return counts.select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(column).alias("value"),
            "n_rows",
        )

    found = []
    for table, key in PRIMARY_KEYS:
        rows = tables.read(table).filter(F.col(key).isNotNull())
        found.append(listed(table, key, "PRIMARY KEY", duplicate_keys(rows, [key])))
    for table, column in NOT_NULL:
        rows = missing_values(tables.read(table), [column])
        counts = rows.groupBy(column).agg(F.count("*").alias("n_rows"))
        found.append(listed(table, column, "NOT NULL", counts))
    for table, key, parent in FOREIGN_KEYS:
        counts = tables.read(table).groupBy(key).agg(F.count("*").alias("n_rows"))
        orphans = without_parent(counts, tables.read(parent), key, null_is_orphan=False)
        found.append(listed(table, key, "FOREIGN KEY", orphans))
    return reduce(DataFrame.unionByName, found)
