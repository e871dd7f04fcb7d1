import hashlib
import random

import numpy as np
import prose
import public_tokenizers
import pytest
import sentencepiece

from chartloom.llm import packing, pieces
from chartloom.llm.queries import BYTE_RANKS, PIECE_MODEL


@pytest.fixture(scope="module")
def model():
    return pieces.load(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def odd_texts():
    draw = random.Random(6)
    alphabet = [*"abcdefghijklmnorstuvwxyzABC 0123456789.,\n\t", "  ", " the", "▁", "\x00", "é", "ß", "日", "🙂", "﻿", "　", "</s>", "<0x41>", " ⁇ ", "́"]
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(60))) for _ in range(4000)]
    wild = ["".join(chr(draw.choice([draw.randrange(0x300), draw.randrange(0xD800), draw.randrange(0xE000, 0x20000)])) for _ in range(20)) for _ in range(500)]
    return [*texts, *wild, "", " ", " " * 90, "a" * 3000, "🙂" * 50, "\n" * 40, "ab" * 900]


def test_like_the_library(model, library):
    for text in odd_texts():
        ids = library.encode(text)
        assert model.encode(text) == ids, text
        assert model.decode(ids) == library.decode(ids), text


def test_decoding_any_ids(model, library):
    draw = random.Random(7)
    for _ in range(5000):
        ids = [draw.choice([draw.randrange(3), draw.randrange(3, 259), draw.randrange(259, 32000), 28705]) for _ in range(draw.randrange(9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_neighbours_stay_apart(model):
    """What backtracking finds is what merging finds."""
    for text in odd_texts()[:600]:
        for stretch in model.stretches(text):
            assert model.backtrack(stretch) == model.merge(stretch)


def test_reports(table, hostile, nothing, library):
    texts = odd_texts()[::7] + [prose.text(500, 1), None]
    for docs in (table(texts), hostile):
        rows = docs.collect()
        got = pieces.report(docs, PIECE_MODEL).collect()
        want = []
        for r in rows:
            ids = library.encode(r.text or "")
            listed = ",".join(map(str, ids))
            want.append((r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, library.decode(ids)))))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    back = pieces.decode(pieces.encode(table(texts), PIECE_MODEL), PIECE_MODEL).collect()
    assert all(r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids) for r in back)
    assert pieces.encode(nothing, PIECE_MODEL).count() == pieces.report(nothing, PIECE_MODEL).count() == 0


def naive_best_fit(lengths, capacity):
    rooms = []
    for size in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= size]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return sorted(rooms)


def test_best_fit_decreasing():
    draw = np.random.default_rng(1)
    for capacity in (1, 7, 64, 100):
        for _ in range(30):
            lengths = draw.integers(1, capacity + 1, draw.integers(0, 120))
            rows = packing.best_fit_decreasing(lengths, capacity)
            assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
            rooms = sorted(capacity - int(lengths[r].sum()) for r in map(np.array, rows))
            assert rooms == naive_best_fit(lengths.tolist(), capacity)


@pytest.mark.parametrize("window", [1 << 30, 300])
def test_packing_round_trip(table, hostile, window):
    model = packing.load(BYTE_RANKS, public_tokenizers.PATTERN)
    docs = table([prose.text(n, n) for n in (0, 1, 5, 40, 100, 400, 7, 64, 63)] * 3).union(hostile.select("doc_id", "text", "lang", "source", "n_chars"))
    found, rows = {}, 0
    for b in packing.pack(docs, BYTE_RANKS, public_tokenizers.PATTERN, 64, window).collect():
        ids = np.frombuffer(b.ids, "<u2").reshape(b.n_rows, 64)
        places = np.frombuffer(b.positions, "<u2").reshape(b.n_rows, 64)
        at = {}
        for s in b.segments:
            r = s.row - b.first_row
            ends = b.cu_seqlens[r]
            begin = ends[at.setdefault(r, 0)]
            at[r] += 1
            assert ends[at[r]] == begin + s.n <= 64
            assert places[r, begin : begin + s.n].tolist() == list(range(s.n))
            found.setdefault(s.doc_id, []).append((s.offset, ids[r, begin : begin + s.n].tolist()))
        rows += b.n_rows
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).extend(model.encode_ordinary(r.text or "") + [packing.CLOSE_ID])
    for doc, parts in found.items():
        assert sorted(i for _, p in parts for i in p) == sorted(want[doc])
    single = [d for d in want if sum(o == 0 for o, _ in found[d]) == 1]
    assert len(single) > 5
    for doc in single:
        assert [i for _, p in sorted(found[doc]) for i in p] == want[doc]


def test_packing_nothing(nothing):
    assert packing.pack(nothing, BYTE_RANKS, public_tokenizers.PATTERN).count() == 0
