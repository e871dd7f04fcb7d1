"""Staging files of several headers, and rows that do not fit theirs."""

import pytest

from chartloom.sources.staging_csv import MOST_HEADERS, read_staging_any


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("multi_line", [True, False])
def test_columns_by_name(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('obs_id,unit,result_value\no1,kg,1.5\no2,"a ""b"", c",N/A\n')
    (tmp_path / "b.csv").write_text("﻿result_value,obs_id\n7,o3\n")
    (tmp_path / "c.csv").write_text("obs_id,unit,result_value\no4,,x\n")
    found = read_staging_any(spark, str(tmp_path), ("result_value",), multi_line)
    assert rows(found.rows, "obs_id", "unit", "result_value", "src_file") == [
        ("o1", "kg", 1.5, "a.csv"), ("o2", 'a "b", c', None, "a.csv"), ("o3", None, 7.0, "b.csv"), ("o4", None, None, "c.csv")
    ]
    assert found.rejects.isEmpty()


def test_bad_rows_are_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("obs_id,unit\no1,kg\no2\no3,kg,more\no4,g\n")
    (tmp_path / "b.csv").write_text("unit,obs_id,x\nkg,o5,1\nkg,o6\n")
    found = read_staging_any(spark, str(tmp_path))
    assert rows(found.rows, "obs_id", "unit", "x") == [("o1", "kg", None), ("o4", "g", None), ("o5", "kg", "1")]
    assert rows(found.rejects, "rule", "file_name", "message") == [
        ("BAD_CSV_ROW", "a.csv", "o2"), ("BAD_CSV_ROW", "a.csv", "o3,kg,more"), ("BAD_CSV_ROW", "b.csv", "kg,o6")
    ]


def test_line_breaks_in_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('obs_id,unit\no1,"k\ng"\n')
    assert rows(read_staging_any(spark, str(tmp_path)).rows, "obs_id", "unit") == [("o1", "k\ng")]


def test_order_of_rows_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "\n".join(map(str, range(500))) + "\n")
    found = read_staging_any(spark, str(tmp_path)).rows.orderBy("src_file", "src_offset", "src_row").collect()
    assert [int(r.n) for r in found] == list(range(500))


def test_what_cannot_be_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("obs_id,obs_id\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_staging_any(spark, str(tmp_path))
    for i in range(MOST_HEADERS + 2):
        (tmp_path / f"f{i}.csv").write_text(f"c{i}\n1\n")
    with pytest.raises(ValueError, match="different headers"):
        read_staging_any(spark, str(tmp_path))
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no file"):
        read_staging_any(spark, str(empty))
