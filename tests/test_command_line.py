"""The jobs in their usual order, from the command line."""

from records import bundle, coded, observation, patient, rows, write

from chartloom.__main__ import main
from chartloom.schemas import STAGED_OBSERVATION
from chartloom.sinks.tables import Tables
from chartloom.sources.staging_csv import read_staging


def test_all_jobs(spark, tmp_path, capsys):
    onward = [{"relation": "next", "url": "u"}]
    fever = {"code": coded("8310-5", "Body temperature"), "valueQuantity": {"value": 38.5}}
    repeats = [observation(f"o{i % 40:02d}", **fever, issued=f"{2000 + i}") for i in range(100)]
    raw = write(
        tmp_path / "raw",
        patient_page_1=bundle(patient("p1"), patient(""), links=onward),
        patient_page_2=bundle(patient("p1", gender="late"), patient("p2")),
        observation_page_1=bundle(*repeats[:50], links=onward),
        observation_page_2=bundle(*repeats[50:], observation("x", "Patient/p9")),
        notes="not a page",
    )
    landed, out, tables = (str(tmp_path / n) for n in ("landed", "out", "tables"))
    main(["inspect", raw, "--names", "*_page_*.json"])
    assert "o00" in capsys.readouterr().out
    main(["land", raw, landed])
    assert "unnamed" in capsys.readouterr().out
    main(["stage", landed, out, "--landed"])
    assert "rejects: 2" in capsys.readouterr().out  # a patient without id, and the notes
    # Staging files are in source order.
    staged = read_staging(spark, f"{out}/observations").orderBy("src_file", "src_offset", "src_row")
    assert staged.columns[: len(STAGED_OBSERVATION)] == STAGED_OBSERVATION
    years = [r.effective_datetime for r in staged.collect()]
    assert years == [*[str(2000 + i) for i in range(100)], None]
    main(["load", out, tables])
    printed = capsys.readouterr().out
    assert "fhir_patients: 2" in printed and "orphans: 1 reassigned: False" in printed
    stored = Tables(spark, tables).read("fhir_observations")
    assert rows(stored, "effective_datetime") == [(str(2000 + i),) for i in range(40)]
    logged = spark.read.parquet(f"{tables}/rejects")
    assert rows(logged, "rule", "resource_id") == [("ORPHAN_PATIENT", "x")]
    main(["check", tables])
    assert "PRIMARY KEY" not in capsys.readouterr().out
    main(["audit", tables, "--rows", "1", "--out", f"{out}/audit"])
    assert "Fever" in capsys.readouterr().out
    assert spark.read.parquet(f"{out}/audit/flagged").count() == 10
    assert spark.read.parquet(f"{out}/audit/n_flagged").first().n_flagged == 40
    main(["dashboard", tables])
    assert "total_patients" in capsys.readouterr().out


def test_direct_staging_gives_the_same(spark, tmp_path, capsys):
    raw = write(tmp_path / "raw", a=bundle(patient("p1"), observation("o1")), cut="{")
    main(["stage", raw, str(tmp_path / "out"), "--names", "*.json"])
    printed = capsys.readouterr().out
    assert "valid patients: 1" in printed and "rejects: 1" in printed


def test_missing_input_keeps_the_last_export(spark, tmp_path, capsys):
    raw = write(tmp_path / "raw", a=bundle(patient("p1"), observation("o1")))
    out = str(tmp_path / "out")
    main(["stage", raw, out])
    for place, names in ((f"{raw}-mistyped", "*"), (raw, "*.jsn")):
        main(["stage", place, out, "--names", names])
        assert "nothing written" in capsys.readouterr().out
    assert read_staging(spark, f"{out}/patients").count() == 1
