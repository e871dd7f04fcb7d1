"""Text to typed values; anything unreadable becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date, and a time of digits, colons and points only: no zone.
_LOCAL = r"^[-+]?\d+(-\d+){0,2}([T ]+[\d:.]*)?$"


def to_date(c: Column) -> Column:
    """Full dates and the shorter year and year-month forms."""
    return c.try_cast("date")


def to_utc(c: Column) -> Column:
    """UTC wall-clock time, whatever the session time zone; text without a zone is UTC."""
    c = F.btrim(c, F.lit(" \t\n\r\f\v"))
    moment = F.unix_micros(c.try_cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = F.timestamp_add("MICROSECOND", moment, epoch)
    return F.when(c.rlike(_LOCAL), c.try_cast("timestamp_ntz")).otherwise(zoned)


def to_number(c: Column) -> Column:
    """Double. Only written-out finite numbers count: text such as ``150d`` is not one, and NaN or
    an infinite value, which would lie above every threshold, is missing."""
    number = c.try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    return F.when(finite & ~c.cast("string").rlike(r"(?i)[df]\s*$"), number)


def finite_sql(column: str) -> str:
    """``to_number`` of a double column as SQL text."""
    return f"CASE WHEN NOT isnan({column}) AND abs({column}) < double('infinity') THEN {column} END"
