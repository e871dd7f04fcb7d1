"""Keys and references between observations, patients and terms.

Joins carry no broadcast hint: the planner broadcasts a side that its size allows, and otherwise
shuffles, where adaptive execution splits partitions of hot keys. In semi, anti and left joins the
large table is on the left, the side that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.ordinal import dense_index
from chartloom.session import materialize


def with_parent(
    child: DataFrame, parent: DataFrame, key: str, keep_null: bool = False
) -> DataFrame:
    """Rows whose key exists in ``parent``; ``keep_null`` also keeps rows without a key."""
    keys = parent.select(F.col(key).alias("_key"))
    if not keep_null:
        return child.join(keys, F.col(key) == F.col("_key"), "left_semi")
    kind = child.schema[key].dataType
    one = child.sparkSession.range(0, 1, 1, numPartitions=1)
    none = one.select(F.lit(None).cast(kind).alias("_key"))
    return child.join(keys.union(none), F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def without_parent(
    child: DataFrame, parent: DataFrame, key: str, null_is_orphan: bool = True
) -> DataFrame:
    """Rows whose key is not in ``parent``. As a foreign key, a NULL key passes."""
    if not null_is_orphan:
        child = child.filter(F.col(key).isNotNull())
    keys = parent.select(F.col(key).alias("_key"))
    return child.join(keys, F.col(key) == F.col("_key"), "left_anti")


def mark_parent(child: DataFrame, parent: DataFrame, key: str, mark: str) -> DataFrame:
    """Add whether the key exists in ``parent``, whose key is unique: both outcomes, one join."""
    keys = parent.select(F.col(key).alias("_key"))
    return (
        child.join(keys, F.col(key) == F.col("_key"), "left")
        .withColumn(mark, F.col("_key").isNotNull())
        .drop("_key")
    )


def no_overlap(child: DataFrame, parent: DataFrame, key: str) -> bool:
    """Whether no key of ``child`` exists in ``parent``. Repeats are gone before the join."""
    return with_parent(child.select(key).distinct(), parent, key).isEmpty()


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on both sides. Without the first step the rows of a hot key would all be shuffled."""
    return left.select(key).distinct().intersect(right.select(key))


def reassign_round_robin(
    observations: DataFrame, patients: DataFrame, order: str = "obs_id"
) -> DataFrame:
    """Give observation *i* the patient *i mod n*, both in key order.

    Replaces the key of every row. Only for data in which no reference matches at all.
    """
    ids = dense_index(patients.select("patient_fhir_id"), ["patient_fhir_id"], "_idx")
    people = materialize(ids, "patient-index")
    n = people.count()
    if n == 0:
        return observations.limit(0)
    readings = dense_index(observations.drop("patient_fhir_id"), [order], "_i").withColumn(
        "_idx", F.pmod("_i", F.lit(n))
    )
    return readings.join(people, "_idx").drop("_idx", "_i").select(observations.columns)


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """The child rows left once the ``deleted`` parents are gone."""
    return without_parent(child, deleted, key)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which a mandatory column is NULL."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return df.filter(condition)
