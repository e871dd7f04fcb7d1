"""Column expressions against plain Python."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chartloom.functions.flags import FLAG_RULES, UNFLAGGED, clinical_flag
from chartloom.functions.text import NA_TOKENS, clean_id, na_to_null
from chartloom.functions.typed import to_date, to_number, to_utc


def one(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def expected_flag(code, display, value):
    for part, name, sign, limit, flag in FLAG_RULES:
        hit = (code is not None and part in code) or (display is not None and name in display.lower())
        if hit and value is not None:
            if {">": value > limit, ">=": value >= limit, "<": value < limit}[sign]:
                return flag
    return UNFLAGGED


def test_flag_at_every_threshold(spark):
    codes = [None, "x", "18480-6", *{r[0] for r in FLAG_RULES}]
    names = [None, "y", "SYSTOLIC and Diastolic", *{r[1].title() for r in FLAG_RULES}]
    limits = {r[3] for r in FLAG_RULES}
    values = [None, *sorted({v + d for v in limits for d in (-0.1, 0.0, 0.1)})]
    cases = [(c, n, v) for c in codes for n in names for v in values]
    df = spark.createDataFrame(cases, "c string, n string, v double")
    found = df.select("c", "n", "v", clinical_flag(F.col("c"), F.col("n"), F.col("v"))).collect()
    assert len(found) == len(cases)
    wrong = [tuple(r) for r in found if r[3] != expected_flag(*r[:3])]
    assert not wrong


def test_number(spark):
    given = ["1", "1.50", "abc", "", None, "NaN", " 7 ", "1e3", "12abc"]
    assert one(spark, to_number, given) == [1.0, 1.5, None, None, None, None, 7.0, 1000.0, None]
    assert one(spark, to_number, [float("nan"), 2.0, None], "double") == [None, 2.0, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_in_any_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    given = {
        "2026-07-20T13:17:02.2998158+00:00": datetime(2026, 7, 20, 13, 17, 2, 299815),
        "2026-07-20T13:27:58.145Z": datetime(2026, 7, 20, 13, 27, 58, 145000),
        "2024-10-06T10:04:48+02:00": datetime(2024, 10, 6, 8, 4, 48),
        "2024-10-06T10:04:48": datetime(2024, 10, 6, 10, 4, 48),
        "2026-11-01T05:30:00Z": datetime(2026, 11, 1, 5, 30),
        "2026-11-01T06:30:00Z": datetime(2026, 11, 1, 6, 30),
        "2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30),
        "2026-07-18": datetime(2026, 7, 18),
        "2026-07": datetime(2026, 7, 1),
        "2026": datetime(2026, 1, 1),
        "soon": None,
        "2026-13-40": None,
    }
    assert one(spark, to_utc, list(given)) == list(given.values())
    days = {"1990-05-17": date(1990, 5, 17), "1990-05": date(1990, 5, 1), "x": None, "1990-02-30": None}
    assert one(spark, to_date, list(days)) == list(days.values())


def test_ids(spark):
    given = {
        " Patient/1\t": "1",
        "urn:uuid:a-b": "a-b",
        "\r\n\x0b\x0c  x　": "x",
        "http://h/Patient/7": "http://h/7",
        "Location/9": "Location/9",
        "Patient/urn:uuid:3": "3",
        "Patient/ 5": " 5",
        "a b": "a b",
    }
    assert one(spark, clean_id, list(given)) == list(given.values())
    plain = [k.strip().replace("Patient/", "").replace("urn:uuid:", "") for k in given]
    assert plain == list(given.values())


def test_na_tokens(spark):
    assert one(spark, na_to_null, [*NA_TOKENS, "na", "0", "N/A ", None]) == [None] * len(
        NA_TOKENS
    ) + ["na", "0", "N/A ", None]


def test_flag_labels(spark):
    """Each rule's label, written out."""
    cases = [
        ("8480-6", None, 141.0, "High Blood Pressure"),
        ("8480-6", None, 89.0, "Low Blood Pressure"),
        (None, "Diastolic", 91.0, "High Blood Pressure"),
        ("39156-5", None, 30.0, "Obese"),
        (None, "Body Mass Index", 29.9, "Overweight"),
        ("39156-5", None, 24.9, "Normal / Unflagged"),
        ("8867-4", None, 101.0, "Tachycardia"),
        (None, "heart rate", 59.0, "Bradycardia"),
        ("8310-5", None, 38.1, "Fever"),
    ]
    df = spark.createDataFrame(cases, "c string, n string, v double, want string")
    got = df.select("want", clinical_flag(F.col("c"), F.col("n"), F.col("v")).alias("got"))
    assert all(r.want == r.got for r in got.collect())


def test_zones_in_every_form(spark, conf):
    for zone in ("UTC", "America/New_York"):
        conf("spark.sql.session.timeZone", zone)
        texts = ["+02", "-05", "+2:00", "Z", "Z ", " UTC", "+0200", "+02:00 ", "", " "]
        got = one(spark, to_utc, [f"2024-10-06T10:04:48{t}" for t in texts])
        assert [g.hour for g in got] == [8, 15, 8, 10, 10, 10, 8, 8, 10, 10]
        assert one(spark, to_utc, ["2024-10-06T10:04:48 Europe/Paris"])[0].hour == 8
        assert [g.day for g in one(spark, to_utc, ["2024-10-06", "2024-10-6"])] == [6, 6]


def test_numbers_with_suffix_or_without_end(spark):
    assert one(spark, to_number, ["150d", "150f", "1.5D ", "1e400", "-1e400", "Infinity", "1e3", " 7 "]) == [
        *[None] * 6, 1000.0, 7.0
    ]
