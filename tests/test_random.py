"""Random bundles and texts against a few lines of plain Python."""

import json
import random

from pyspark.sql import functions as F
from records import rows, write

from chartloom.functions.text import clean_id
from chartloom.operators.conform import keep_first, terminology
from chartloom.plans.staging import stage_governed
from chartloom.schemas import STAGED_OBSERVATION, STAGED_PATIENT

rng = random.Random(7)


def maybe(*values):
    """One of the values; ``...`` stands for a missing key."""
    return rng.choice(values)


def made(**fields):
    return {k: v for k, v in fields.items() if v is not ...}


def random_coding():
    code = maybe(..., None, "8480-6", "x y")
    return made(code=code, display=maybe(..., None, 'Näme "q"', "a\tb"))


def random_resource(i):
    kind = maybe("Patient", "Observation", "Observation", "Device", ...)
    return made(
        resourceType=kind,
        id=maybe(f"r{i}", f"r{i}", f"r{i}", "", None, ...),
        gender=maybe(..., None, "male"),
        birthDate=maybe(..., "1990", "1990-05-06"),
        address=maybe(..., None, [], [{}], [{"postalCode": "A"}, {"postalCode": "B"}], {"postalCode": "C"}),
        subject=maybe(*[{"reference": f"Patient/{i}"}] * 3, {"reference": ""}, {}, None, ...),
        code=maybe(..., None, {"text": "t"}, {"coding": []}, {"coding": {}})
        if rng.random() < 0.3
        else {"coding": [random_coding() for _ in range(rng.randint(1, 3))]},
        valueQuantity=maybe(..., None, {"value": i, "unit": "kg"}, {"value": i / 4}, {"unit": "/min"}),
        effectiveDateTime=maybe(..., "2024-01-02T03:04:05Z"),
        issued=maybe(..., "2023-01-01"),
        status="final",
        note=[{"text": "not read"}],
    )


def first(value, field):
    return value[0].get(field) if isinstance(value, list) and value else None


def expected(resource):
    """The kind of record and its fields, or the rule it fails."""
    kind, id_ = resource.get("resourceType"), resource.get("id")
    if kind not in ("Patient", "Observation"):
        return None
    if not id_:
        return "MISSING_ID", ()
    if kind == "Patient":
        postal = first(resource.get("address"), "postalCode")
        return kind, (id_, resource.get("gender"), resource.get("birthDate"), postal)
    reference = (resource.get("subject") or {}).get("reference")
    if not reference:
        return "MISSING_SUBJECT", ()
    coding = (resource.get("code") or {}).get("coding")
    quantity = resource.get("valueQuantity") or {}
    value = quantity.get("value")
    return kind, (
        id_,
        reference,
        first(coding, "code"),
        first(coding, "display"),
        None if value is None else json.dumps(value),
        quantity.get("unit"),
        resource.get("effectiveDateTime", resource.get("issued")),
    )


def test_random_bundles(spark, tmp_path):
    files, wanted = {}, []
    for f in range(80):
        resources = [random_resource(f * 100 + i) for i in range(rng.randint(0, 25))]
        files[f"f{f}"] = {"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]}
        wanted += [e for e in map(expected, resources) if e]
    found = stage_governed(spark, write(tmp_path, **files))

    def of(kind):
        return sorted((fields for k, fields in wanted if k == kind), key=repr)

    assert rows(found.patients, *STAGED_PATIENT) == of("Patient")
    assert rows(found.observations, *STAGED_OBSERVATION) == of("Observation")
    failed = sorted((k,) for k, _ in wanted if k.startswith("MISSING"))
    assert rows(found.rejects, "rule") == failed
    assert len(of("Patient")) > 50 and len(of("Observation")) > 50 and len(failed) > 50


def test_random_references(spark):
    parts = ["Patient/", "urn:uuid:", "Patient", "/", " ", "\t", " ", " ", "a", "7", "Location/"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(3_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("c", clean_id(F.col("t")))
    for text, cleaned in df.collect():
        assert cleaned == text.strip().replace("Patient/", "").replace("urn:uuid:", ""), repr(text)


def test_random_repeats(spark):
    """Keep-first and terminology by a two-column order, with a hot key and missing values."""
    data = [
        (
            maybe("hot", "hot", None, f"k{rng.randint(0, 300)}"),
            maybe(None, "One", "Two", "Three"),
            f"f{rng.randint(0, 9)}",
            i,
        )
        for i in rng.sample(range(10_000), 4_000)
    ]
    df = spark.createDataFrame(data, "loinc_code string, display_name string, f string, n int")
    firsts = {}
    for code, display, *_ in sorted(data, key=lambda r: r[2:]):
        firsts.setdefault(code, display)
    split = df.repartition(12)
    kept = keep_first(split, ["loinc_code"], ["f", "n"])
    assert rows(kept, "loinc_code", "display_name") == sorted(firsts.items(), key=repr)
    named = [(c, d or "Unknown Display Name") for c, d in firsts.items()]
    assert rows(terminology(split, ["f", "n"])) == sorted(named, key=repr)
