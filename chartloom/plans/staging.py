"""Bundles to staged records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators import governance as gov
from chartloom.operators.nested import observation_fields, of_type, patient_fields, resources
from chartloom.schemas import LINEAGE, STAGED_OBSERVATION, STAGED_PATIENT
from chartloom.session import materialize
from chartloom.sinks.files import log_rejects, write_staging
from chartloom.sources.bundles import empty_files, is_missing, read_bundles


def stage_patients(bundles: DataFrame) -> DataFrame:
    """All patients, unchecked."""
    return of_type(resources(bundles), gov.PATIENT).select(*LINEAGE, *patient_fields())


def stage_observations(bundles: DataFrame) -> DataFrame:
    """All observations, unchecked."""
    return of_type(resources(bundles), gov.OBSERVATION).select(*LINEAGE, *observation_fields())


@dataclass
class Staged:
    patients: DataFrame
    observations: DataFrame
    rejects: DataFrame
    found: bool = True  # whether there was any input

    def export(
        self, patients_path: str, observations_path: str, rejects_path: str, in_order: bool = False
    ) -> bool:
        """Write the staging files and append to the rejects log; whether that was done. Without any
        input, as from a mistyped path, an earlier export stays as it is.

        ``in_order`` sorts the files by source position, for a load from these files, which takes
        the first of repeated records. A load from the frames themselves does not need it.
        """
        if not self.found:
            return False
        for df, columns, path in (
            (self.patients, STAGED_PATIENT, patients_path),
            (self.observations, STAGED_OBSERVATION, observations_path),
        ):
            ordered = df.orderBy(*LINEAGE) if in_order else df
            write_staging(ordered.select(columns), path)
        log_rejects(self.rejects, rejects_path)
        return True


def routed(bundles: DataFrame) -> DataFrame:
    """Checked flat records of both types with their ``route``: patient, observation or reject.

    Fields that the types do not share are NULL for the other one.
    """
    tagged = gov.tag(resources(bundles))
    route = F.when(F.col("rule").isNotNull(), F.lit("reject")).otherwise(F.lower("resourceType"))
    return tagged.select(
        *LINEAGE,
        "resourceType",
        "id",
        "rule",
        *patient_fields()[1:],
        *observation_fields()[1:],
        route.alias("route"),
    )


def split_routes(stored: DataFrame) -> Staged:
    """The three outputs of stored routed records."""
    patients = stored.filter("route = 'patient'").withColumnRenamed("id", "patient_fhir_id")
    observations = stored.filter("route = 'observation'").withColumnRenamed("id", "obs_id")
    return Staged(
        patients.select(*LINEAGE, *STAGED_PATIENT),
        observations.select(*LINEAGE, *STAGED_OBSERVATION),
        gov.rejects(stored.filter("route = 'reject'")),
    )


def stage_bundles(bundles: DataFrame) -> Staged:
    """Valid patients, valid observations and rejects from one pass over the JSON.

    The flat records are stored once, split by route; each output then reads its own part.
    """
    return split_routes(materialize(routed(bundles), "staged", ["route"]))


def stage_governed(
    spark: SparkSession, *paths: str, names: str | None = None, multi_line: bool = True
) -> Staged:
    """Staged bundle files, files of no bytes among the rejects."""
    staged = stage_bundles(read_bundles(spark, *paths, names=names, multi_line=multi_line))
    none = staged.patients.isEmpty() and staged.observations.isEmpty()
    if multi_line:
        events = gov.corrupt_files(empty_files(spark, *paths, names=names))
        staged.rejects = staged.rejects.unionByName(events)
    if none and staged.rejects.isEmpty():
        staged.found = not is_missing(spark, *paths, names=names)
    return staged
