"""Fields of bundles landed as variants."""

from chartloom.sources import variants as V

PAGES = [
    ("Patient", 1, '{"entry":[{"resource":{"resourceType":"Patient","id":"p1","gender":7,"address":[{"postalCode":"Z1"}]}},'
     '{"resource":{"resourceType":"Patient","id":"p2","gender":null,"address":{"postalCode":"no list"}}}]}'),
    ("Observation", 1, '{"entry":[{"resource":{"resourceType":"Observation","id":"o1","effectiveDateTime":null,"issued":"i"}},'
     '{"resource":{"resourceType":"Observation","id":"o2","issued":"i","code":{"coding":{"code":"x"}},"valueQuantity":{"value":"12.5"}}},'
     '{"resource":{"resourceType":"Observation","id":"o3","effectiveDateTime":"e","issued":"i","valueQuantity":{"value":7}}}, 5, null]}'),
    ("Observation", 2, "{not json"),
    ("Observation", 3, '{"entry":{"resource":{"resourceType":"Observation","id":"lost"}}}'),
    ("Observation", 4, "null"),
    ("Observation", 5, None),
]


def test_fields(spark, tmp_path):
    V.land_variants(spark.createDataFrame(PAGES, "resource_type string, page long, payload string"), str(tmp_path / "v"))
    landed = V.read_variants(spark, str(tmp_path / "v"))
    assert landed.count() == 6
    entries = V.variant_entries(landed)
    people = sorted(tuple(r) for r in V.variant_patients(entries).drop("page", "src_pos").collect())
    assert people == [("p1", "7", None, "Z1"), ("p2", None, None, None)]
    seen = V.variant_observations(entries).select("obs_id", "loinc_code", "result_value", "effective_datetime").collect()
    assert sorted(tuple(r) for r in seen) == [("o1", None, None, None), ("o2", None, 12.5, "i"), ("o3", None, 7.0, "e")]


def test_parsed_once(spark, tmp_path):
    """The landing parses; no plan that reads it does."""
    V.land_variants(spark.createDataFrame(PAGES, "resource_type string, page long, payload string"), str(tmp_path / "v"))
    entries = V.variant_entries(V.read_variants(spark, str(tmp_path / "v")))
    for df in (V.variant_patients(entries), V.variant_observations(entries)):
        plan = df._jdf.queryExecution().toString()
        assert "parse_json" not in plan and "from_json" not in plan
