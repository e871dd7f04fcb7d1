"""Identifier and missing-value text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank, up to the last one defined.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Reference prefixes, in the order in which they are removed.
REFERENCE_PREFIXES = ["Patient/", "urn:uuid:"]

# Text the staging reader takes as missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
NA_EXPORT = "N/A"


def trim_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def strip_reference(c: Column) -> Column:
    """Remove the reference prefixes wherever they occur; other prefixes stay."""
    for prefix in REFERENCE_PREFIXES:
        c = F.replace(c, F.lit(prefix), F.lit(""))
    return c


def clean_id(c: Column) -> Column:
    return strip_reference(trim_blanks(c))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def null_to_na(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NA_EXPORT))


def is_blank(c: Column) -> Column:
    """Missing or empty: what a truthiness test rejects."""
    return F.coalesce(c, F.lit("")) == ""
