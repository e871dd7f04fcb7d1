"""Staged records to the three stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from chartloom.operators.conform import (
    clean_observations,
    clean_patients,
    keep_first,
    pick,
    terminology,
)
from chartloom.operators.governance import orphan_rejects
from chartloom.operators.integrity import mark_parent, reassign_round_robin
from chartloom.plans import maintained
from chartloom.schemas import LINEAGE, OBSERVATIONS
from chartloom.session import materialize
from chartloom.sinks.segments import delete_keys, replace_segmented, segments_for
from chartloom.sinks.tables import Tables


@dataclass
class Loaded:
    orphans: DataFrame
    reassigned: bool


def load_tables(
    tables: Tables,
    patients: DataFrame,
    observations: DataFrame,
    order: list[str] | None = None,
    on_no_match: str = "drop",
    null_code: str | None = None,
) -> Loaded:
    """Clean, keep the first record per id, derive terms, load; a second run gives the same.

    The new tables are published as one version at the end, so that a load that fails leaves the old
    ones, and no reader sees tables of different loads.

    Observations of unknown patients are not loaded but returned as quarantine rows. With
    ``on_no_match='reassign'``, and only if no reference at all matches a patient, observations
    are dealt out to the patients in turn instead. Codes need no check of their own, as the terms
    come from the same rows.
    """
    if on_no_match not in ("drop", "reassign"):
        raise ValueError("on_no_match is 'drop' or 'reassign'")
    order = order or [c for c in LINEAGE if c in observations.columns]
    if not order:
        raise ValueError("name the columns that tell which of repeated records is first")
    new = tables.change()

    people = keep_first(clean_patients(patients), ["patient_fhir_id"], order)
    new.replace("fhir_patients", people)
    people = new.read("fhir_patients")

    # One shuffle by id, one join; both kinds of row are stored, by kind, and read from there.
    needed = dict.fromkeys([*OBSERVATIONS.fieldNames(), "display_name", "src_file", *order])
    cleaned = pick(clean_observations(observations, null_code), list(needed))
    marked = mark_parent(keep_first(cleaned, ["obs_id"], order), people, "patient_fhir_id", "known")
    stored = materialize(marked, "observations", ["known"])
    terms = terminology(stored, order).filter("loinc_code IS NOT NULL")
    new.replace("terminology_lookup", terms)

    known = stored.filter("known")
    reassign = on_no_match == "reassign" and known.isEmpty()
    if reassign:
        known = reassign_round_robin(pick(stored, OBSERVATIONS.fieldNames()), people)
    new.replace("fhir_observations", known)
    new.publish()
    orphans = stored.filter("NOT known")
    return Loaded(orphan_rejects(orphans.limit(0) if reassign else orphans), reassign)


def cluster(tables: Tables, segments: int | None = None) -> None:
    """Put patients and observations into segments by patient, so that deletions rewrite few files.
    ``tables`` have a table of segment filters (``schemas.SEGMENTED_TABLES``)."""
    with tables.change() as new:
        for name in ("fhir_observations", "fhir_patients"):
            rows = new.read(name)
            replace_segmented(new, name, rows, "patient_fhir_id", segments or segments_for(rows.count()))


def delete_patients(tables: Tables, deleted: DataFrame) -> dict[str, dict[str, int]]:
    """Delete patients (``patient_fhir_id``) and with them their observations, published together.

    Of tables in segments only those segments are written that may hold one of these patients.
    Returns for each table how many segments were rewritten, and how many taken over as they are.
    """
    gone = materialize(deleted.select("patient_fhir_id"), "deleted")
    with tables.change() as new:
        if maintained.kept(new):
            maintained.remove(new, gone, "deleted")
        return {
            name: delete_keys(new, name, gone, "patient_fhir_id")
            for name in ("fhir_observations", "fhir_patients")
        }
