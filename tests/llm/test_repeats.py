import hashlib
import random

import prose
import pytest

from chartloom.llm import superkmer as K


def brute(rows):
    """(doc_id, n_words, n_removed, digest), from a dictionary of all windows."""
    split = [(doc, prose.WORD.findall(text or "")) for doc, text, *_ in rows]
    first = {}
    for doc, words in split:
        for i in range(len(words) - 49):
            key = tuple(words[i : i + 50])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - 49):
            if first[tuple(words[i : i + 50])] < doc:
                gone |= set(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    passage, other = prose.text(70, 1), prose.text(50, 2)
    texts = [prose.text(300, i + 10) for i in range(12)]
    texts += [f"{prose.text(60, i)}\n{passage}\t{prose.text(40, i + 50)}" for i in range(30, 70)]
    texts += [texts[0], texts[0], texts[1][5:], other, f"a {other}", f"{other} b", passage.replace(" ", "  \n")]
    texts += ["same " * 400, "same " * 200, "the same " * 700, prose.text(49, 5), prose.text(49, 5), None, ""]
    ids = draw.sample(range(1000), len(texts))
    return [(i, t, "en", "a") for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("bucket", [1_000, 4])
def test_removed_words(table, rows, monkeypatch, bucket):
    monkeypatch.setattr(K, "BUCKET", bucket)
    got = sorted(map(tuple, K.report(table(rows)).collect()))
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 2000


def test_shortened_texts(table, rows):
    got = {r.doc_id: r for r in K.remove_repeats(table(rows, gone="'own'")).collect()}
    want = {doc: (n, gone) for doc, n, gone, _ in brute(rows)}
    for doc, text, *_ in rows:
        n, gone = want[doc]
        if not gone:
            assert got[doc].text == text
        elif gone == n:
            assert doc not in got
        else:
            assert len(prose.WORD.findall(got[doc].text)) == n - gone
            assert got[doc].n_chars == len(got[doc].text)
        assert doc not in got or got[doc].gone == "own"


def test_equal_ids_keep_their_words(table):
    text = prose.text(80, 1)
    got = K.report(table([(1, text, "en", "a"), (1, text + " more", "en", "a"), (2, text, "en", "a"), (None, text, "en", "a")]))
    assert sorted((r.doc_id or 9, r.n_removed) for r in got.collect()) == [(1, 0), (1, 0), (2, 80), (9, 80)]


def test_hostile(hostile, nothing):
    got = K.report(hostile)
    assert got.count() == hostile.count()
    assert K.remove_repeats(hostile).columns == hostile.columns
    assert K.report(nothing).count() == K.remove_repeats(nothing).count() == 0


def test_repeated_rows_are_cut_once(table):
    rows = [(None, "the same text", "en", "a")] * 50 + [(1, "the same text", "en", "a"), (2, None, "en", "a"), (2, None, "en", "a")]
    once = K._once(K._keyed(table(rows)).select("doc", "version", "text"))
    assert sorted((r.doc == 1, r.text or "") for r in once.collect()) == [(False, ""), (False, "the same text"), (True, "the same text")]
