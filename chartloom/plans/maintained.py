"""Reports from counts that are kept with the tables, not counted again.

Every change adds signed rows to a table of counts per patient, test and flag, in the version it makes:
a load what it added, a deletion what the deleted patients had. Their sum is what counting the timeline
would give. Sketches of the patients of each flag are kept beside them, one per batch; sketches can be
united but take nothing back, so a deletion makes them anew from the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators import reports
from chartloom.operators.timeline import name_and_flag
from chartloom.sinks.tables import Change, Reader

DELTAS, SKETCHES = "activity_deltas", "patient_sketches"
GROUP = ["patient_fhir_id", "test_name", "clinical_flag"]
#: Size of a sketch: 2 to the power of this many registers. Its relative standard error, some 1.04 / sqrt of
#: that number.
SKETCH_LOG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG / 2)


def kept(tables: Reader) -> bool:
    """Whether these tables have counts."""
    return DELTAS in tables.schemas


def counts(tables: Reader) -> DataFrame:
    """Timeline rows ``n`` per patient, test and flag, as ``reports.activity`` counts them."""
    return tables.read(DELTAS).groupBy(*GROUP).agg(F.sum("n").alias("n")).where("n <> 0")


def add(new: Change, observations: DataFrame, batch_id: str) -> None:
    """Count observations that were added and whose patients are there."""
    named = name_and_flag(observations.select("patient_fhir_id", "loinc_code", "result_value"), new.read("terminology_lookup"))
    delta = named.groupBy(*GROUP).agg(F.count("*").alias("n"))
    part = new.write(DELTAS, delta.withColumn("batch_id", F.lit(batch_id)))
    new.tables[DELTAS] = (*new.parts(DELTAS), part)
    new.append(SKETCHES, _sketches(new.read_parts(DELTAS, (part,)), batch_id))


def _sketches(delta: DataFrame, batch_id: str) -> DataFrame:
    made = delta.groupBy("clinical_flag").agg(F.hll_sketch_agg("patient_fhir_id", F.lit(SKETCH_LOG)).alias("sketch"))
    return made.withColumn("batch_id", F.lit(batch_id))


def remove(new: Change, gone: DataFrame, why: str) -> None:
    """Take back what the patients in ``gone`` had: it is in the counts, no observation is read."""
    keys = gone.select(F.col("patient_fhir_id").alias("_gone"))
    had = counts(new).join(keys, F.col("patient_fhir_id") == F.col("_gone"), "left_semi")
    new.append(DELTAS, had.select(*GROUP, (-F.col("n")).alias("n"), F.lit(why).alias("batch_id")))
    new.replace(SKETCHES, _sketches(counts(new), why))


def fold(new: Change) -> None:
    """Sum the counts up into one folder."""
    new.replace(DELTAS, counts(new).withColumn("batch_id", F.lit("folded")))


def dashboard(tables: Reader) -> dict[str, DataFrame]:
    """Indicators, both distributions and the number of flagged observations, from the counts."""
    now = counts(tables)
    return {
        "kpis": reports.kpis(now),
        "n_flagged": reports.n_flagged(now),
        "flag_distribution": reports.value_counts(now, "clinical_flag", "n"),
        "test_distribution": reports.value_counts(now, "test_name", "n"),
    }


def patients_per_flag(tables: Reader) -> DataFrame:
    """clinical_flag and about how many patients have it, from the sketches of all batches; with no flag
    the patients of all."""
    sketches = tables.read(SKETCHES)
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("patients")
    each = sketches.groupBy("clinical_flag").agg(united)
    every = sketches.agg(united).where("patients IS NOT NULL").select(F.lit(None).cast("string").alias("clinical_flag"), "patients")
    return each.unionByName(every)
