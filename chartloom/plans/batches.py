"""Loads in batches: checked before they are published, counted once, the same as one load.

All that a batch changes is one version. The ledger of batches is a table of the same version, so a batch
that is given again, after a job of which nobody knows how it ended, is told from a new one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import keyfilter
from chartloom.operators.conform import clean_observations, clean_patients, keep_first, pick, terminology
from chartloom.operators.integrity import duplicate_keys, mark_parent, missing_values, without_parent
from chartloom.plans import maintained
from chartloom.schemas import (
    BATCH_TABLES,
    FOREIGN_KEYS,
    LINEAGE,
    MAINTAINED_TABLES,
    NOT_NULL,
    OBSERVATIONS,
    PARKED,
    PRIMARY_KEYS,
)
from chartloom.session import materialize
from chartloom.sinks.tables import Change, Tables, fit

PUBLISHED, REFUSED, REPEATED = "published", "refused", "repeated"
#: Observations that the key filter is first made for; it grows by a factor of 4.
EXPECTED_KEYS = 1 << 20


def batch_tables(spark: SparkSession, root: str, counted: bool = False) -> Tables:
    """The stored tables with the ledger, the parked observations and the key filter; and, if asked for,
    with the counts that reports come from."""
    return Tables(spark, root, schemas=MAINTAINED_TABLES if counted else BATCH_TABLES)


@dataclass
class Outcome:
    """What became of a batch; the rows that speak against it, one per rule and value."""

    state: str
    violations: DataFrame | None = None


def _counted(tables: Tables | Change, batch_id: str) -> bool:
    return not tables.read("load_ledger").where(F.col("batch_id") == batch_id).isEmpty()


def _enter(new: Change, batch_id: str, rows: dict[str, DataFrame]) -> None:
    """Write the batch into the ledger, with the rows it added to each table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in rows.items()
    ]
    if not counts:
        counts = [new.spark.createDataFrame([(None, 0)], "table_name string, n_rows long")]
    entered = reduce(DataFrame.unionByName, counts).select(
        F.lit(batch_id).alias("batch_id"), "table_name", "n_rows", F.current_timestamp().alias("applied_at")
    )
    new.append("load_ledger", entered)


def _violation(rows: DataFrame, table: str, column: str, rule: str, value: str | None = None) -> DataFrame:
    value_ = F.lit(None).cast("string") if value is None else F.col(value).cast("string")
    return rows.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
        value_.alias("value"), "n_rows",
    )


def audit(added: dict[str, DataFrame], stored: Tables | Change) -> DataFrame:
    """Rules that rows break which are to be ``added`` to what is ``stored``: keys that come twice or are
    there already, missing mandatory values, references to no stored or added row. Of the stored
    tables key columns alone are read."""
    found = []
    for table, key in PRIMARY_KEYS:
        if table in added:
            keys = added[table].select(key).where(F.col(key).isNotNull())
            twice = duplicate_keys(keys, [key])
            found.append(_violation(twice, table, key, "PRIMARY KEY", key))
            there = keys.distinct().join(stored.read(table).select(key), key, "left_semi")
            there = there.withColumn("n_rows", F.lit(1).cast("long"))
            found.append(_violation(there, table, key, "STORED KEY", key))
    for table, column in NOT_NULL:
        if table in added:
            none = missing_values(added[table], [column]).agg(F.count("*").alias("n_rows"))
            found.append(_violation(none.where("n_rows > 0"), table, column, "NOT NULL"))
    for table, column, parent in FOREIGN_KEYS:
        if table in added:
            key = dict(PRIMARY_KEYS)[parent]
            parents = stored.read(parent).select(F.col(key).alias(column))
            if parent in added:
                parents = parents.unionByName(added[parent].select(F.col(key).alias(column)))
            seen = added[table].groupBy(column).agg(F.count("*").alias("n_rows"))
            lost = without_parent(seen, parents, column, null_is_orphan=False)
            found.append(_violation(lost, table, column, "FOREIGN KEY", column))
    return reduce(DataFrame.unionByName, found)


def append_checked(tables: Tables, batch_id: str, rows: dict[str, DataFrame]) -> Outcome:
    """Write rows to a side version, audit them with the stored keys, and publish all or nothing.

    A batch that the ledger has is left alone. A refused batch leaves no trace but its violations.
    """
    new = tables.change()
    if _counted(new, batch_id):
        return Outcome(REPEATED)
    before = tables.pinned()
    parts = {name: new.write(name, df) for name, df in rows.items()}
    added = {name: new.read_parts(name, (part,)) for name, part in parts.items()}
    violations = materialize(audit(added, before), "violations")
    if not violations.isEmpty():
        return Outcome(REFUSED, violations)
    for name, part in parts.items():
        new.tables[name] = (*new.parts(name), part)
    _enter(new, batch_id, added)
    new.publish()
    return Outcome(PUBLISHED, violations)


_KEY = "_first_by"


def _keyed(df: DataFrame) -> DataFrame:
    """With the key of keep-first: the id, a missing one like any other."""
    return df.withColumn(_KEY, F.coalesce("obs_id", F.lit("\0")))


def _filter_blocks(filters: DataFrame) -> int:
    first = filters.select("blocks").first()
    return first.blocks if first else 0


def _unseen(new: Change, batch: DataFrame) -> DataFrame:
    """Rows of a batch whose key is neither loaded nor parked. The stored key filter tells at once that
    most keys are new; only the others meet the stored keys, and only those stored keys move that
    are among the others' (a semi-join before the shuffle if these are few)."""
    filters = new.read("observation_key_filter")
    blocks = _filter_blocks(filters)
    if not blocks:
        return batch
    asked = materialize(keyfilter.ask(batch, _KEY, keyfilter.unite(filters), blocks, "_maybe"), "asked")
    maybe = asked.where("_maybe")
    if maybe.isEmpty():
        return asked.drop("_maybe")
    stored = reduce(
        DataFrame.unionByName, [_keyed(new.read(t).select("obs_id")) for t in ("fhir_observations", "parked_observations")]
    ).select(F.col(_KEY).alias("_stored"))
    seen = materialize(
        maybe.select(_KEY).join(stored, F.col(_KEY) == F.col("_stored"), "left_semi"), "seen"
    )
    left = maybe.join(seen.withColumnRenamed(_KEY, "_seen"), F.col(_KEY) == F.col("_seen"), "left_anti")
    return asked.where("NOT _maybe").unionByName(left).drop("_maybe")


def _note_keys(new: Change, arrivals: DataFrame) -> None:
    """Put the keys of new rows into the key filter; make it anew, larger, when it is full."""
    filters = new.read("observation_key_filter")
    blocks = _filter_blocks(filters)
    ledger = new.read("load_ledger").where("table_name = 'arrivals'").agg(F.coalesce(F.sum("n_rows"), F.lit(0)))
    n = ledger.first()[0] + arrivals.count()
    size = blocks or keyfilter.blocks_for(EXPECTED_KEYS)
    while size < keyfilter.blocks_for(n):
        size *= 4
    keys = arrivals.select(_KEY)
    if blocks and size > blocks:
        for table in ("fhir_observations", "parked_observations"):
            keys = keys.unionByName(_keyed(new.read(table).select("obs_id")).select(_KEY))
    made = keyfilter.build(keys, _KEY, size).withColumn("blocks", F.lit(size).cast("long"))
    if blocks == size:
        new.append("observation_key_filter", made)
    else:
        new.replace("observation_key_filter", made)


def load_batch(
    tables: Tables, batch_id: str, patients: DataFrame, observations: DataFrame, order: list[str] | None = None
) -> Outcome:
    """Clean a batch and add it: the same tables as one load of all batches, in the order they came in,
    once the last one is there.

    Records whose id an earlier batch had are dropped, as by keep-first; the first display of a code
    stays. Observations of unknown patients are parked whole, with their source, by the patient they lack,
    and come back with the batch that brings this patient.
    """
    new = tables.change()
    if _counted(new, batch_id):
        return Outcome(REPEATED)
    order = order or [c for c in LINEAGE if c in observations.columns]
    if not order:
        raise ValueError("name the columns that tell which of repeated records is first")

    known = new.read("fhir_patients").select("patient_fhir_id")
    people = keep_first(clean_patients(patients), ["patient_fhir_id"], order)
    people = _absent(people, known, "patient_fhir_id")
    new.append("fhir_patients", people)
    people = new.read_parts("fhir_patients", new.parts("fhir_patients")[-1:])

    needed = dict.fromkeys([*OBSERVATIONS.fieldNames(), "display_name", "src_file", "src_path", "src_row", *order])
    cleaned = pick(clean_observations(observations), list(needed))
    first = materialize(_keyed(keep_first(cleaned, ["obs_id"], order)), "batch")
    arrivals = _unseen(new, first)
    everyone = new.read("fhir_patients")
    arrivals = materialize(mark_parent(arrivals, everyone, "patient_fhir_id", "known"), "arrivals", ["known"])
    _note_keys(new, arrivals)

    terms = terminology(arrivals, order).where("loinc_code IS NOT NULL")
    new.append("terminology_lookup", _absent(terms, new.read("terminology_lookup").select("loinc_code"), "loinc_code"))

    parked = new.read("parked_observations")
    back = materialize(mark_parent(parked, people, "patient_fhir_id", "known"), "parked", ["known"])
    released = back.where("known")
    orphans = fit(arrivals.where("NOT known").withColumn("batch_id", F.lit(batch_id)), PARKED)
    new.append("fhir_observations", arrivals.where("known"))
    if released.isEmpty():
        new.append("parked_observations", orphans)
    else:
        new.append("fhir_observations", released)
        new.replace("parked_observations", fit(back.where("NOT known"), PARKED).unionByName(orphans))
    if maintained.kept(new):
        columns = ["patient_fhir_id", "loinc_code", "result_value"]
        maintained.add(new, arrivals.where("known").select(columns).unionByName(released.select(columns)), batch_id)
    _enter(new, batch_id, {"fhir_patients": people, "arrivals": arrivals, "released": released})
    new.publish()
    return Outcome(PUBLISHED)


def _absent(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored; NULL is a key like any other."""
    keys = stored.select(F.col(key).alias("_there"))
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_there")), "left_anti")
