"""Compare a query with its SQL as bags of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> int:
    """Assert equal column names and rows; the number of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    want, got = bag(result.fetchall(), names), bag(df.collect(), df.columns)
    assert got == want, {
        "only spark": list((got - want).items())[:3],
        "only sql": list((want - got).items())[:3],
        "rows": (sum(got.values()), sum(want.values())),
    }
    return sum(got.values())
