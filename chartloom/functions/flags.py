"""Clinical risk flag, compiled from a rule table to one CASE expression."""

from __future__ import annotations

import operator
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# Part of the code, part of the lower-case display, test, limit, flag.
# The first rule that holds wins.
FLAG_RULES = [
    ("8480-6", "systolic", ">", 140.0, "High Blood Pressure"),
    ("8480-6", "systolic", "<", 90.0, "Low Blood Pressure"),
    ("8462-4", "diastolic", ">", 90.0, "High Blood Pressure"),
    ("39156-5", "body mass index", ">=", 30.0, "Obese"),
    ("39156-5", "body mass index", ">=", 25.0, "Overweight"),
    ("8867-4", "heart rate", ">", 100.0, "Tachycardia"),
    ("8867-4", "heart rate", "<", 60.0, "Bradycardia"),
    ("8310-5", "body temperature", ">", 38.0, "Fever"),
]
UNFLAGGED = "Normal / Unflagged"

_TESTS = {">": operator.gt, ">=": operator.ge, "<": operator.lt}


def clinical_flag_sql(code: str, display: str, value: str, rules=FLAG_RULES) -> str:
    """The same as SQL text, for views that outlive a session."""
    branches = " ".join(
        f"WHEN (contains({code}, '{part}') OR contains(lower({display}), '{name}'))"
        f" AND {value} {sign} {limit} THEN '{flag}'"
        for part, name, sign, limit, flag in rules
    )
    return f"CASE {branches} ELSE '{UNFLAGGED}' END"


def clinical_flag(code: Column, display: Column, value: Column, rules=FLAG_RULES) -> Column:
    """Flag of one reading. ``value`` must already be a number without NaN.

    Rules for one measurement share a branch whose number test comes first, so the text is
    searched once per measurement and only for readings that are out of range.
    """
    name = F.lower(display)
    flag = None
    for (code_part, name_part), group in groupby(rules, key=lambda r: r[:2]):
        tests = [(_TESTS[sign](value, F.lit(limit)), label) for _, _, sign, limit, label in group]
        out_of_range = reduce(operator.or_, (test for test, _ in tests))
        measured = code.contains(code_part) | name.contains(name_part)
        label = reduce(
            lambda case, t: case.when(*t) if case is not None else F.when(*t),
            [(test, F.lit(text)) for test, text in tests],
            None,
        )
        branch = (out_of_range & measured, label)
        flag = F.when(*branch) if flag is None else flag.when(*branch)
    return flag.otherwise(F.lit(UNFLAGGED))
