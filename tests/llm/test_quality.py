import random
from collections import Counter

import prose
import pytest

from chartloom.llm import quality


def counts(text):
    words = prose.WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if prose.WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        dup,
        len(covered),
    )


def _junk(seed):
    draw = random.Random(seed)
    return "".join(draw.choice(["a ", "b ", "é", "日本 ", "\n", "#", "x y z u v ", "\t", "\x85", "*|"]) for _ in range(60))


def test_counts(table):
    texts = [_junk(i) for i in range(150)] + [None, "", "\n\n", "a\na\na", "a b c d e " * 40]
    rows = quality.with_counts(table(texts)).collect()
    for row in rows:
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == counts(row.text), row.text


def _bucket(v):
    width = 1 << max(0, len(f"{v:b}") - 6)
    return v - v % width


def _quantile(values, q):
    values = sorted(map(_bucket, values))
    return next(v for i, v in enumerate(values, 1) if 4 * i >= q * len(values))


def brute(rows):
    """Verdict of each row, with fences from sorted lists."""
    judged, groups = [], {}
    for doc, text, lang, source in rows:
        n, chars, symbols, dup, repeat = counts(text)
        failed = n < 10 or 100 * repeat > 20 * n
        values = (1000 * symbols // max(chars, 1), 1000 * dup // max(n, 1), 100 * chars // max(n, 1))
        judged.append((doc, failed, values, lang, source))
        if not failed:
            for key in ((lang, source), (lang,), ()):
                groups.setdefault(key, []).append(values)
    out = []
    for doc, failed, values, lang, source in judged:
        kept = not failed
        if kept:
            keys = [(lang, source), (lang,), ()]
            key = next((k for k in keys if len(groups[k]) >= quality.MIN_GROUP), ())
            for i, least in enumerate(quality.MEASURES.values()):
                own = [v[i] for v in groups[key]]
                low, high = _quantile(own, 1), _quantile(own, 3)
                spread = quality.REACH * max(high - low, least)
                kept &= low - spread <= values[i] <= high + spread
        out.append((doc, failed, kept))
    return out


def test_verdicts(table, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 20)
    rows = []
    for i in range(160):
        words = prose.words(40, i)
        if i % 11 == 0:
            words = [w + "%%%" for w in words]
        if i % 13 == 0:
            words = [w * 9 for w in words]
        group = ("en", "a") if i < 100 else ("de", "b") if i < 130 else (None, "c") if i < 145 else ("fr", None)
        rows.append((i, " ".join(words), *group))
    got = quality.quality(table(rows)).select("doc_id", "base_failed", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
    assert {False, True} == {r.kept for r in got}
    kept = quality.keep_good(table(rows, n_words="'own'")).collect()
    assert {r.doc_id for r in kept} == {d for d, _, k in brute(rows) if k}
    assert {r.n_words for r in kept} == {"own"}


def test_sketches_merge(table):
    """Counts of parts add up to those of the whole."""
    rows = [(i, prose.text(30, i), "en", "a") for i in range(60)]

    def cells(part):
        found = quality.sketches(quality.with_counts(table(part))).collect()
        return Counter({(r.measure, r.bucket): r.n for r in found})

    assert cells(rows[:25]) + cells(rows[25:]) == cells(rows)


def test_hostile(hostile, nothing):
    rows = quality.quality(hostile).collect()
    assert len(rows) == hostile.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    assert quality.quality(nothing).count() == 0
    assert quality.keep_good(hostile).columns == hostile.columns
    assert quality.keep_good(nothing).count() == 0
