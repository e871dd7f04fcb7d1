"""Kept counts equal counting again, after any changes."""

import random

from chartloom.operators import reports
from chartloom.plans import maintained as M
from chartloom.plans.batches import batch_tables, load_batch
from chartloom.plans.load import cluster, delete_patients

PERSON = "patient_fhir_id string, gender string, n long"
READING = "obs_id string, patient_reference string, loinc_code string, display_name string, result_value double, n long"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def check(tables):
    now = [tables.read(t) for t in ("fhir_patients", "fhir_observations", "terminology_lookup")]
    want = reports.activity(*now)
    columns = ["patient_fhir_id", "test_name", "clinical_flag", "n"]
    assert rows(M.counts(tables), *columns) == rows(want, *columns)
    assert rows(M.dashboard(tables)["kpis"], "*") == rows(reports.kpis(want), "*")
    exact = {r.clinical_flag: r.n for r in want.select("clinical_flag", "patient_fhir_id").distinct().groupBy("clinical_flag").count().withColumnRenamed("count", "n").collect()}
    about = {r.clinical_flag: r.patients for r in M.patients_per_flag(tables).collect()}
    assert set(about) - {None} == set(exact)
    assert all(abs(about[f] - n) <= 1 + 0.1 * n for f, n in exact.items())


def test_loads_and_deletions(spark, tmp_path):
    draw = random.Random(3)
    tables = batch_tables(spark, str(tmp_path), counted=True)
    check(tables)
    for step in range(3):
        people = [(f"p{i}", None, i) for i in range(step * 20, step * 20 + 25)]
        readings = [
            (f"o{draw.randrange(400)}", f"p{draw.randrange(70)}", draw.choice(["8480-6", "x", None]), draw.choice(["Systolic", None]),
             float(draw.randrange(60, 180)), i)
            for i in range(150)
        ]
        load_batch(tables, f"b{step}", spark.createDataFrame(people, PERSON), spark.createDataFrame(readings, READING), ["n"])
        check(tables)
        gone = spark.createDataFrame([(f"p{draw.randrange(60)}",) for _ in range(4)] + [(None,), ("nobody",)], "patient_fhir_id string")
        delete_patients(tables, gone)
        check(tables)
        if step == 1:
            cluster(tables, 6)
            with tables.change() as new:
                M.fold(new)
            check(tables)
