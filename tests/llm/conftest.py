import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from chartloom.llm.cluster import ship

    ship(spark)


@pytest.fixture(scope="session")
def table(spark):
    """A table of documents from texts, or from (doc_id, text, lang, source)."""

    def make(rows, **extra):
        full = []
        for i, row in enumerate(rows):
            doc, text, lang, source = row if isinstance(row, tuple) else (i, row, "en", "a")
            full.append((doc, text, lang, source, len(text or "")))
        df = spark.createDataFrame(full, SCHEMA)
        for name, value in extra.items():
            df = df.selectExpr("*", f"{value} AS `{name}`")
        return df

    return make


#: Nulls in every column, empty and blank texts, one very long word, one very long text, ties,
#: repeated rows and an id with two texts.
HOSTILE = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, " \n\t ", "en", None),
    (4, "x" * 70_000, "en", "a"),
    (5, "long text of many words " * 20_000, "de", "b"),
    (6, "repeated row with a few words in it", "en", "a"),
    (6, "repeated row with a few words in it", "en", "a"),
    (7, "one id", "en", "a"),
    (7, "two texts", "en", "a"),
    (None, "no id at all but some text", "en", "a"),
    (None, None, None, None),
    (8, "é ü 日本語 🙂 \x00 \x85", "fr", "c"),
    (9, "#*$%&|<> ...", "fr", "c"),
]
#: Names that operators use inside or return.
CLASHING = {c: "'kept as it is'" for c in ("n_words", "kept", "rest", "node", "label", "size", "copies", "gone", "doc", "version", "bucket", "measure", "ids_")}


@pytest.fixture(scope="session")
def hostile(table):
    return table(HOSTILE, **CLASHING)


@pytest.fixture(scope="session")
def nothing(table):
    return table([])
