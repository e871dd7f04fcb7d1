"""Files of no bytes, found by executors."""

import pytest
from pyspark.sql import functions as F

from chartloom.sources import listing
from chartloom.sources.bundles import empty_files


@pytest.fixture
def tree(tmp_path):
    for path, text in {
        "a_page_1.json": "", "b.json": "{}", "c d+%20.json": "", "_hidden.json": "", ".x.json": "",
        "kind=1/a_page_1.json": "", "kind=2/deep/er/é.json": "", "kind=2/deep/full.json": "x", "other/b.txt": "",
    }.items():
        at = tmp_path / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(text)
    return tmp_path


def below(df, root):
    return sorted(r.src_path.removeprefix(f"file:{root}/") for r in df.collect())


def test_empty_files(spark, tree):
    every = ["a_page_1.json", "c d+%20.json", "kind=1/a_page_1.json", "kind=2/deep/er/é.json", "other/b.txt"]
    assert below(empty_files(spark, str(tree)), tree) == every
    assert below(empty_files(spark, f"file://{tree}/"), tree) == every
    assert below(empty_files(spark, str(tree), names="*.json"), tree) == every[:-1]
    assert below(empty_files(spark, str(tree), names="a_page_[0-9].{json,txt}"), tree) == [every[0], every[2]]
    assert below(empty_files(spark, f"{tree}/kind=*"), tree) == every[2:4]
    assert below(empty_files(spark, f"{tree}/*.json"), tree) == every[:2]
    assert below(empty_files(spark, f"{tree}/a_page_1.json", f"{tree}/nowhere", f"{tree}/a_page_1.json"), tree) == every[:1]
    assert empty_files(spark, f"{tree}/nowhere").isEmpty()


def test_where_executors_have_no_client(spark, tree, monkeypatch):
    want = below(empty_files(spark, str(tree)), tree)
    monkeypatch.setattr(listing, "_by_executors", lambda path: False)
    assert below(empty_files(spark, str(tree)), tree) == want


def test_sizes_and_rounds(spark, tree, monkeypatch):
    rounds = []
    real = listing.materialize
    monkeypatch.setattr(listing, "materialize", lambda df, label: rounds.append(label) or real(df, label))
    found = listing.files(spark, str(tree))
    assert len(rounds) == 4  # the depth of the tree
    assert found.where(F.col("size") > 0).count() == 2
