"""Audit and dashboard frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chartloom.operators import reports
from chartloom.operators.timeline import newest_first, normalise, timeline
from chartloom.session import materialize


def counted(patients: DataFrame, observations: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored counts that all reports but the short list and the timeline come from."""
    return materialize(reports.activity(patients, observations, terms), "activity")


def audit(
    patients: DataFrame, observations: DataFrame, terms: DataFrame, counts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Flag breakdown, newest flagged observations, their number and whether there are none.

    All but the short list come from the ``counted`` counts, made here unless they are given.
    """
    if counts is None:
        counts = counted(patients, observations, terms)
    return {
        "flag_breakdown": reports.value_counts(counts, "clinical_flag", "n"),
        "flagged": reports.audit_list(timeline(patients, observations, terms)),
        "n_flagged": reports.n_flagged(counts),
        "none_flagged": reports.is_empty(reports.flagged(counts)),
    }


def dashboard(
    patients: DataFrame, observations: DataFrame, terms: DataFrame, counts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Typed timeline, indicators and two distributions, these from the ``counted`` counts."""
    if counts is None:
        counts = counted(patients, observations, terms)
    rows = timeline(patients, observations, terms)
    return {
        "timeline": normalise(newest_first(rows)),
        "kpis": reports.kpis(counts),
        "flag_distribution": reports.value_counts(counts, "clinical_flag", "n"),
        "test_distribution": reports.value_counts(counts, "test_name", "n"),
    }
