import zlib

import numpy as np
import pyarrow as pa
import pytest

from chartloom.llm import langid, toxicity
from chartloom.llm import text as T

TABLES = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    return docs, spark.read.parquet(f"{TABLES}/labels.parquet")


def test_language_held_out(given):
    docs, _ = given
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_toxicity_held_out(given):
    docs, labels = given
    got = toxicity.report(docs, labels).toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit / (held.toxic == 1).sum() > 0.85
    assert hit / (held.predicted == 1).sum() > 0.8


def test_recurrent_gradients():
    draw = np.random.default_rng(0)
    h = langid.HIDDEN
    shapes = ((2, 256, 3 * h), (2, h, 3 * h), (2 * h, 3))
    model = langid.Model(list("abc"), *(draw.normal(0, 0.3, s) for s in shapes), np.zeros(3))
    codes, target = draw.integers(97, 100, (5, 6)).astype(np.uint8), draw.integers(0, 3, 5)

    def loss():
        p = langid._labels(model, langid._states(model, codes).astype(float))
        return -np.log(p[np.arange(5)[:, None], np.arange(6)[None], target[:, None]]).mean()

    for value, grad in zip((model.byte, model.state, model.out, model.shift), langid._gradients(model, codes, target), strict=True):
        for at in np.argsort(-np.abs(grad).ravel())[:4]:
            at = np.unravel_index(at, grad.shape)
            old, ends = value[at], []
            for step in (1e-3, -1e-3):
                value[at] = old + step
                ends.append(loss())
            value[at] = old
            assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(grad[at], rel=0.02, abs=1e-5)


def test_equal_stretches_are_run_once():
    """The mean over positions, as if every stretch were run by itself."""
    model = langid.train(["the cat sat on the mat", "le chat est sur le tapis"] * 3, ["en", "fr"] * 3)
    texts = ["the the cat le " + "x" * 80, "", "tapis"]
    got = langid.probabilities(model, T.Words(*T.texts(pa.array(texts))))
    for text, p in zip(texts, got, strict=True):
        parts = [w[i : i + 32] for w in text.encode().split() for i in range(0, len(w), 32)]
        rows = [langid._labels(model, langid._states(model, np.frombuffer(b" " + w + b" ", np.uint8)[None]))[0] for w in parts]
        want = np.concatenate(rows).mean(axis=0) if rows else np.zeros(2)
        assert p == pytest.approx(want, abs=1e-5)


def test_filters_by_loops():
    """Pooled filter values of whole texts, and the descent's direction."""
    draw = np.random.default_rng(3)
    texts = ["a b c d b", "", "a", "x y"]
    f = toxicity.features(T.Words(*T.texts(pa.array(texts)), T.TERM))
    total = sum(toxicity.WIDTHS) * toxicity.FILTERS
    model = toxicity.Model(
        draw.normal(0, 1, (toxicity.BUCKETS, toxicity.DIM)).astype(np.float32),
        draw.normal(0, 1, (toxicity.DIM, total)).astype(np.float32),
        draw.normal(0, 0.1, 3 * toxicity.FILTERS).astype(np.float32),
        draw.normal(0, 1, 3 * toxicity.FILTERS).astype(np.float32),
        0.1,
    )
    pooled, _, _ = toxicity._pool(model, f)
    for i, text in enumerate(texts):
        rows = f.rows[f.first[i] : f.first[i + 1]]
        vectors = model.table[rows].sum(axis=1)
        for k, width in enumerate(toxicity.WIDTHS):
            for c in range(toxicity.FILTERS):
                found = [0.0]
                for at in range(len(vectors)):
                    value = model.bias[k * toxicity.FILTERS + c]
                    for j in range(min(width, len(vectors) - at)):
                        column = toxicity._columns(width)[0] + j * toxicity.FILTERS + c
                        value += vectors[at + j] @ model.kernel[:, column]
                    found.append(value)
                assert pooled[i, k * toxicity.FILTERS + c] == pytest.approx(max(found), abs=1e-4)
    labels = np.array([1, 0, 0, 1])

    def loss():
        z = toxicity.logit(model, f)
        return np.mean(np.log1p(np.exp(-np.where(labels == 1, z, -z))))

    before, memory = loss(), {"table": np.full(toxicity.BUCKETS, 1e-2, np.float32)}
    for _ in range(30):
        toxicity._step(model, f, labels, np.ones(4), memory)
    assert loss() < before


def test_best_cut():
    z, y = np.array([0.0, 1.0, 2.0, 5.0, 6.0]), np.array([0, 0, 0, 1, 1])
    assert toxicity._best(z, y) == 3.5


def test_hostile(spark, hostile, nothing, table):
    got = {r.doc_id: r for r in langid.report(hostile).collect()}
    assert langid.report(hostile).count() == hostile.count()
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 9))
    assert langid.report(nothing).count() == 0
    unknown = table([(1, "some text", None, "a")])
    assert langid.report(unknown).first().lang_pred == "und"
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (6, None, None), (None, 1, 1), (8, 1, 0), (9, 1, 1)], none.schema)
    for labels in (none, some):
        rows = toxicity.report(hostile, labels).collect()
        assert len(rows) == hostile.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.predicted == 0 for r in toxicity.report(hostile, none).collect())
    assert toxicity.report(nothing, some).count() == 0


def test_one_repeated_id_does_not_fill_the_sample(table, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANG", 5)
    ids = [(i, f"text {i}", "en", "a") for i in range(60)]
    rows = [row for row in ids for _ in range(40)]
    got = langid.sample(table(rows)).collect()
    assert len(got) == len({r.doc_id for r in got}) == 5


def test_only_letters_have_a_language(table):
    rows = [(i, f"some words of a language {i}", "en", "a") for i in range(30)]
    rows += [(100 + i, t, None, "a") for i, t in enumerate(["²", "½ ①", "Ⅷ", "12 !", "ª", "日"])]
    got = {r.doc_id: r.lang_pred for r in langid.report(table(rows)).collect()}
    assert [got[100 + i] for i in range(6)] == ["und"] * 4 + ["en"] * 2


def test_languages_learned_have_a_bound(table, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    rows = [(i, f"text {i}", f"l{(i % 32).bit_length()}", "a") for i in range(640)]
    assert {r.lang for r in langid.sample(table(rows)).collect()} == {"l3", "l4", "l5"}


def test_sample_of_a_class(spark, table, monkeypatch):
    """The lowest hashes of each class, of which few meet in one task; labels other than 0 and 1 are none."""
    monkeypatch.setattr(toxicity, "PER_CLASS", 20)
    rows = [(i, f"text {i}", "en", "a") for i in range(3000)]
    labels = spark.createDataFrame([(i, 1, 7 if i % 50 == 3 else int(i % 5 == 0)) for i in range(3000)], "doc_id long, quality int, toxic int")
    got = toxicity.sample(table(rows), labels).collect()
    drawn = labels.where("toxic IN (0, 1)").where(~toxicity.held_out(labels.doc_id)).selectExpr(
        "doc_id", "toxic", "pmod(xxhash64(doc_id), 4294967296) AS h").collect()
    for toxic in (0, 1):
        want = sorted((r.h, r.doc_id) for r in drawn if r.toxic == toxic)[:20]
        assert sorted(r.doc_id for r in got if r.toxic == toxic) == sorted(d for _, d in want)


def _marked(spark, table, n=3000, words=60):
    """Texts of which every fifth is toxic by one of many words; held-out ones have the same words."""
    draw = np.random.default_rng(4)
    plain = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [plain[j] for j in draw.integers(0, 300, 30)]
        if i % 5 == 0:
            text[draw.integers(0, 30)] = f"{i // 5 % words}vile"
        rows.append((i, " ".join(text), "en" if i % 2 else None, "a"))
        labels.append((i, 1, int(i % 5 == 0)))
    return table(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_every_labelled_text_is_learned_from(spark, table, monkeypatch):
    """Words that a bounded sample has not met are known as well; parts of a table do not matter."""
    monkeypatch.setattr(toxicity, "PER_CLASS", 20)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 10)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 1 << 17)
    docs, labels = _marked(spark, table)
    got = toxicity.report(docs.repartition(3), labels).orderBy("doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) > 0.98 * len(held)
    again = toxicity.report(docs.repartition(7), labels.repartition(5)).orderBy("doc_id").collect()
    assert got == again


def test_counts_of_all_shards(spark, table, monkeypatch):
    """Shards hold every labelled text once, equal rows with their number, and counts are over all of them."""
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 1 << 14)
    docs, labels = _marked(spark, table, 600)
    long = table([(600, "vile " * 30_000, "fr", "a"), (602, None, "fr", "a")])
    more = spark.createDataFrame([(600, 1, 1), (602, 1, 1), (1, 1, None), (4, 1, 7)], labels.schema)
    docs, labels = docs.union(docs.where("doc_id % 3 = 0")).union(long), labels.where("doc_id NOT IN (1, 4)").union(more)
    assert zlib.crc32(b"600") % 3 != 1
    toxic = {r.doc_id: r.toxic for r in labels.where("toxic IN (0, 1)").collect()}
    want = [(r, toxic[r.doc_id]) for r in docs.collect() if r.doc_id in toxic and r.text and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]

    rows = toxicity.labelled(docs, labels)
    assert rows.selectExpr("sum(copies)").first()[0] == len(want)
    packed = toxicity.shards(rows)
    assert packed.count() > 5
    spare = {r.doc_id for r in rows.where("spare").collect()}
    trained = [(r.text, r.lang, y) for r, y in want if r.doc_id not in spare]
    counted = packed.mapInArrow(toxicity._count, toxicity.COUNTED)
    got = {(r.kind, r.lang, r.bucket): (r.clean, r.toxic) for r in counted.groupBy("kind", "lang", "bucket").sum("clean", "toxic").toDF("kind", "lang", "bucket", "clean", "toxic").collect()}
    expected = {}
    for text, lang, y in trained:
        f = toxicity.features(T.Words(*T.texts(pa.array([text])), T.TERM))
        for k in range(3):
            for bucket in set(f.rows[:, k].tolist()):
                now = expected.setdefault((k, None, bucket), [0, 0])
                now[y] += 1
        for bucket in f.langs.tolist() if lang else []:
            expected.setdefault((3, lang, bucket), [0, 0])[0] += 1
    assert got == {k: tuple(v) for k, v in expected.items()}


def test_best_cut_of_counted_logits():
    draw = np.random.default_rng(6)
    z, y = draw.integers(0, 20, 40).astype(float), draw.integers(0, 2, 40)
    copies = draw.integers(1, 4, 40)
    assert toxicity._best(z, y, copies) == toxicity._best(np.repeat(z, copies), np.repeat(y, copies))
