import hashlib
import math
import re
from collections import Counter

import numpy as np
import prose
import pytest

from chartloom.llm import imatch

TERM = re.compile(r"[^\W_]+", re.ASCII)


def test_pairs_and_texts(table, hostile):
    texts = [prose.text(5 + 7 * i, i % 20) + " é日🙂"[: i % 5] for i in range(60)] + ["", None, "x"]
    for docs in (table([(7 * i % 997, t, "en", "a") for i, t in enumerate(texts)]), hostile):
        rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        got = imatch.report(docs).collect()
        assert len(got) == len(rows)
        want = []
        for a, b in zip(rows, rows[1:] + rows[:1], strict=True):
            text, half = a.text or "", len(a.text or "") // 2
            new = text[: len(text) - half] + (b.text or "")[:half]
            want.append((a.doc_id, len(text), hashlib.sha256(new.encode()).hexdigest()))
        assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_fingerprints_by_hand(table, monkeypatch):
    """Band, subsets and hashes, from dictionaries."""
    monkeypatch.setattr(imatch, "RARE", 0.06)
    texts = [prose.text(60, i, 600) for i in range(80)]
    band = imatch.lexicon(table(texts))
    terms = [set(TERM.findall(t.lower())) for t in texts]
    df = Counter(w for t in terms for w in t)
    low, high = max(2, 0.06 * len(texts)), imatch.COMMON * len(texts)
    want = {w for w, n in df.items() if low <= n <= high}
    assert 0 < len(band) == len(want)
    ids = {w: int(imatch.T.Words(*imatch.T.texts(imatch.pa.array([w])), imatch.T.TERM).hashes(True)[0]) for w in df}
    assert set(band.tolist()) == {ids[w] for w in want}
    members = imatch._members(band)
    chosen = dict(zip(band.tolist(), members, strict=True))
    for text, own in zip(texts, terms, strict=True):
        parts = []
        for k in range(len(imatch.CHANCES)):
            inside = sorted(ids[w] for w in own & want if chosen[ids[w]][k])
            data = np.array(inside, np.uint64).tobytes()
            parts.append(hashlib.blake2b(data, digest_size=4).hexdigest() if inside else imatch.NONE)
        got = imatch.fingerprints([text], band, members)[0]
        assert got[: 8 * len(parts)] == "".join(parts)


def test_likeness(table):
    band = np.sort(imatch.T.mix(np.arange(5000)))
    members = imatch._members(band)
    assert members.mean(axis=0) == pytest.approx(imatch.CHANCES, abs=0.03)
    texts = [prose.text(300, i) for i in range(30)]
    band = imatch.lexicon(table(texts * 3))
    a, b, c = imatch.fingerprints([texts[0], texts[0].upper(), texts[1]], band, imatch._members(band))
    assert imatch.likeness(a, b) == 1.0 > imatch.likeness(a, c)
    assert math.isclose(imatch.likeness(a, c), imatch.likeness(c, a))


def test_a_larger_table_keeps_the_band(table):
    """Twice the documents, with the same shares: the same terms."""
    texts = [prose.text(60, i, 3000) for i in range(600)]
    once, twice = (imatch.lexicon(table(texts * k)) for k in (1, 2))
    assert len(once) and set(once.tolist()) <= set(twice.tolist())
    assert len(imatch.lexicon(table(texts * 4))) == len(twice)


def test_texts_of_a_rare_language(table):
    """No term in the band: subsets of all terms, so that a changed word does not change them all."""
    texts = [prose.text(80, i, 300) for i in range(1200)]
    rare = " ".join(f"rare{i}" for i in range(120))
    band = imatch.lexicon(table([*texts, rare]))
    a, b, c = imatch.fingerprints([rare, rare.replace("rare7 ", "other "), texts[0]], band, imatch._members(band))
    assert a != b and 0.7 < imatch.likeness(a, b) < 1
    assert imatch.likeness(a, c) < 0.2


def test_nothing(nothing, table):
    assert imatch.report(nothing).count() == 0
    one = imatch.report(table(["only one text here"])).first()
    assert one.near_next == 1.0
