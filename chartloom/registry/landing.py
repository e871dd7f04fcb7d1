"""Landed bundles made from the given tables, as input of the scan queries.

``event_id`` and ``c_custkey`` are unique, so ``PAGE_SIZE`` consecutive keys bound every page. The
bundles are written once per session and table folder, in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.registry import roles
from chartloom.session import materialize, work_path
from chartloom.sinks.files import land_lines
from chartloom.sources.bundles import read_bundles

PAGE_SIZE = 100

_pages: dict[tuple[str, str], DataFrame] = {}
_lines: dict[tuple[str, str], str] = {}


def _quoted(c: str | Column) -> Column:
    """Text as a JSON string, with what must be escaped escaped; NULL stays NULL."""
    text = F.col(c) if isinstance(c, str) else c
    listed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def _member(name: str, value: Column) -> Column:
    """``"name":value``, left out when the value is NULL."""
    return F.concat(F.lit(f'"{name}":'), value)


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _code() -> Column:
    """The coding in all its forms: two, one, without display, text only, empty, not a list."""
    coding = _object(
        _member("code", _quoted("loinc_code")), _member("display", _quoted("display_name"))
    )
    only = _object(_member("coding", F.concat(F.lit("["), coding, F.lit("]"))))
    second = '{"code":"second","display":"Second coding"}'
    both = _object(_member("coding", F.concat(F.lit("["), coding, F.lit(f",{second}]"))))
    return (
        F.when(F.col("event_type") == "click", both)
        .when(F.col("loinc_code").isNotNull(), only)
        .when(F.col("value") < 5, F.lit('{"text":"Blood Pressure"}'))
        .when(F.col("value") < 10, F.lit('{"coding":[]}'))
        .otherwise(F.lit('{"coding":{"code":"not-a-list"}}'))
    )


def _observation() -> Column:
    moment = _quoted("effective_datetime")
    issued_only = F.col("event_type") == "error"
    quantity = F.when(
        F.col("result_value").isNotNull(),
        _object(
            _member("value", F.col("result_value").cast("string")),
            _member("unit", _quoted("unit")),
        ),
    )
    resource = _object(
        F.lit('"resourceType":"Observation"'),
        _member("id", _quoted("obs_id")),
        F.when(
            F.col("patient_reference").isNotNull(),
            _member("subject", _object(_member("reference", _quoted("patient_reference")))),
        ),
        _member("code", _code()),
        _member("valueQuantity", quantity),
        F.when(~issued_only, _member("effectiveDateTime", moment)),
        F.when(issued_only, _member("issued", moment)).when(
            F.col("event_type") == "click", F.lit('"issued":"1999-01-01"')
        ),
    )
    return _object(_member("resource", resource))


def _patient() -> Column:
    address = F.when(
        F.col("postal_code").isNotNull(),
        F.concat(F.lit("["), _object(_member("postalCode", _quoted("postal_code"))), F.lit("]")),
    ).when(F.col("gender") == "building", F.lit('{"postalCode":"not-a-list"}'))
    resource = _object(
        F.lit('"resourceType":"Patient"'),
        _member("id", _quoted("patient_fhir_id")),
        _member("gender", _quoted("gender")),
        _member("birthDate", _quoted("birth_date")),
        _member("address", address),
    )
    return _object(_member("resource", resource))


def page_url(resource_type: str, page: Column) -> Column:
    return F.format_string(f"https://records.example/{resource_type}?page=%d", page)


def _bundles(entries: DataFrame, resource_type: str) -> DataFrame:
    """Pages of ``entries(key, entry)``, closed by an empty page and one without ``entry``."""
    page = F.expr(f"key div {PAGE_SIZE}")
    filled = (
        entries.withColumn("page", page)
        .groupBy("page")
        .agg(F.sort_array(F.collect_list(F.struct("key", "entry"))).alias("items"))
        .select(
            "page",
            _member(
                "entry",
                F.concat(F.lit("["), F.concat_ws(",", F.col("items.entry")), F.lit("]")),
            ).alias("entry"),
        )
    )
    none = F.lit(None).cast("string")
    ends = entries.agg(F.max(page).alias("last")).select(
        F.inline(
            F.array(
                F.struct((F.col("last") + 1).alias("page"), F.lit('"entry":[]').alias("entry")),
                F.struct((F.col("last") + 2).alias("page"), none.alias("entry")),
            )
        )
    )
    here = F.concat(
        F.lit('{"relation":"self","url":"'), page_url(resource_type, F.col("page")), F.lit('"}')
    )
    after = F.concat(
        F.lit('{"relation":"next","url":"'),
        page_url(resource_type, F.col("page") + 1),
        F.lit('"}'),
    )
    onward = F.when(F.col("entry").isNull(), F.lit("")).otherwise(F.concat(F.lit(","), after))
    links = F.concat(F.lit("["), here, onward, F.lit("]"))
    return filled.unionByName(ends).select(
        F.lit(resource_type).alias("resource_type"),
        "page",
        _object(
            F.lit('"resourceType":"Bundle"'),
            _member("id", _quoted(F.col("page").cast("string"))),
            _member("link", links),
            F.col("entry"),
        ).alias("payload"),
    )


def _make_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.table(spark, sf_dir, "events").selectExpr(
        "event_id AS key", "event_type", "value", *roles.RAW_OBSERVATION
    )
    people = roles.table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", *roles.PATIENT)
    observations = _bundles(events.select("key", _observation().alias("entry")), "Observation")
    return observations.unionByName(
        _bundles(people.select("key", _patient().alias("entry")), "Patient")
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bundles, stored: ``resource_type, page, payload``."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _pages:
        _pages[key] = materialize(_make_pages(spark, sf_dir), "raw-pages")
    return _pages[key]


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one line per bundle, by resource type."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _lines:
        path = work_path(spark, "landing")
        land_lines(pages(spark, sf_dir), path)
        _lines[key] = path
    return _lines[key]


def bundles(spark: SparkSession, sf_dir: str, resource_type: str = "*") -> DataFrame:
    folder = f"{landing(spark, sf_dir)}/resource_type={resource_type.lower()}"
    return read_bundles(spark, folder, multi_line=False)
