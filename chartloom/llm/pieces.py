"""Exact merge-type piece encoding by backtracking, and decoding.

The library's merge encoder joins the best-scored neighbouring pieces until nothing can be joined.
Its result is the one sequence of pieces in which every two neighbours, merged afresh on their own,
stay apart. So it is found from the left: take the longest piece that starts here (all pieces that
start at each place come from one Aho-Corasick pass), check it against the piece before by merging
the two afresh, and where no piece fits, give up the last one and mark the place as failed. A place
is reached in one way only, so a bit per place is enough and none is tried twice.

A merge makes a piece, so none crosses a place that no piece of the model lies across. No piece has a
space mark after another character, and if none has a Latin letter next to another character, texts
are cut there as well. Stretches between cuts are encoded one by one, and short ones are
remembered in a bounded table. Characters without a piece become one piece for each of their bytes.

Nulls: a null text is an empty one, which has no ids. Any text decodes to what the library decodes.
Repeated rows are encoded alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from chartloom.llm import text as T

MARK = "▁"
#: What the library shows for its unknown piece.
UNKNOWN = " ⁇ "
#: Stretches of at most REMEMBER_CHARS characters are remembered, REMEMBER in each generation.
REMEMBER = 120_000
REMEMBER_CHARS = 48
PAIRS = 300_000
#: Space marks with the Latin letters, or with the other characters, after them; or up to the next.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_FINE = re.compile(f"{MARK}*[{_LATIN}]+|{MARK}*[^{_LATIN}{MARK}]+|{MARK}+")
_COARSE = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Remembered:
    """A bounded table of short stretches in two generations: when the younger is full, the older
    is given up, and what was used since is in the younger again."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def get(self, stretch: str):
        found = self.young.get(stretch)
        if found is None:
            found = self.old.get(stretch)
            if found is not None:
                self.keep(stretch, found)
        return found

    def keep(self, stretch: str, value):
        if len(stretch) <= REMEMBER_CHARS:
            if len(self.young) >= REMEMBER:
                self.young, self.old = {}, self.young
            self.young[stretch] = value
        return value


class Pieces:
    """A merge-type model: its pieces, scores and byte pieces."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece, self.rank, self.byte = {}, {}, {}
        self.shown: list[str | int | None] = []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
                self.shown.append(int(name[3:5], 16))
            elif model.is_control(i):
                self.shown.append("")
            elif model.is_unknown(i) or model.is_unused(i):
                self.shown.append(UNKNOWN if model.is_unknown(i) else name)
            else:
                if MARK in name.lstrip(MARK):
                    raise ValueError("a piece with a space mark inside: stretches would depend on each other")
                self.piece[name], self.rank[name] = i, -model.get_score(i)
                self.shown.append(name.replace(MARK, " "))
        # A piece that merging its own characters does not give never occurs.
        self.automaton = ahocorasick.Automaton()
        reached = {name for name in self.piece if self.merge(name) == [name]}
        for name in reached:
            self.automaton.add_word(name, (len(name) - 1, name))
        self.automaton.make_automaton()
        #: The longest piece that is the beginning of a piece.
        self.shorter: dict[str, str] = {}
        for name in reached:
            begins = (name[:n] for n in range(len(name) - 1, 0, -1))
            if (found := next((b for b in begins if b in reached), None)) is not None:
                self.shorter[name] = found
        fine = all(_FINE.fullmatch(name) and len(_FINE.findall(name)) == 1 for name in reached)
        self.stretch = _FINE if fine else _COARSE
        self.remembered: Remembered = Remembered()
        self.apart = lru_cache(PAIRS)(self._apart)

    def merge(self, text: str) -> list[str]:
        """Join the best-scored neighbours, the leftmost of equals, until none can be joined."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                rank = self.rank.get(parts[i] + parts[j])
                if rank is not None:
                    heappush(queue, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i]
            if parts[i] is None or len(parts[i]) != a or j >= len(parts) or len(parts[j]) != b:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _apart(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay as they are when merged afresh."""
        return self.merge(left + right) == [left, right]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a stretch; a character that has none stands for itself."""
        longest: dict[int, str] = {}
        for end, (back, name) in self.automaton.iter(text):
            longest[end - back] = name  # from one place, longer pieces end later
        apart, shorter, size = self.apart, self.shorter, len(text)
        failed = bytearray((size >> 3) + 1)
        taken: list[str] = []
        place, last, option = 0, None, longest.get(0) or text[:1]
        while place < size:
            while option is not None:
                end = place + len(option)
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or apart(last, option)):
                    break
                option = shorter.get(option)
            if option is None:
                failed[place >> 3] |= 1 << (place & 7)
                gone = taken.pop()
                place, option = place - len(gone), shorter.get(gone)
                last = taken[-1] if taken else None
            else:
                taken.append(option)
                place, last = end, option
                option = longest.get(place) or text[place : place + 1]
        return taken

    def fresh_ids(self, stretch: str) -> tuple[int, ...]:
        found: list[int] = []
        for p in self.backtrack(stretch):
            i = self.piece.get(p)
            found += [i] if i is not None else [self.byte[b] for b in p.encode()]
        return tuple(found)

    def ids(self, stretch: str) -> tuple[int, ...]:
        known = self.remembered.get(stretch)
        if known is None:
            known = self.remembered.keep(stretch, self.fresh_ids(stretch))
        return known

    def stretches(self, text: str) -> list[str]:
        """The text, with the space that the library puts in front, cut where no piece could lie
        across: before space marks, and between Latin letters and others if no piece has both."""
        return self.stretch.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for s in self.stretches(text):
            out += self.ids(s)
        return out

    def spelled(self, ids) -> list[str]:
        """Pieces with spaces for marks, and bytes of neighbouring byte pieces as UTF-8, one
        replacement mark for each byte that is not."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            shown = self.shown[i]
            if isinstance(shown, int):
                pending.append(shown)
                continue
            if pending:
                out.append(_characters(bytes(pending)))
                pending.clear()
            out.append(shown)
        if pending:
            out.append(_characters(bytes(pending)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, without the space in front."""
        joined = "".join(self.spelled(ids))
        first = next((self.shown[i] for i in ids if self.shown[i] != ""), None)
        opens = isinstance(first, str) and first.startswith(" ") and first != UNKNOWN
        return joined[1:] if opens else joined


def _characters(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            if at + size <= len(data):
                at += size
                break
        else:
            out.append("�")
            at += 1
    return "".join(out)


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The model at ``path``, once per process; the file must be there on every executor."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        # What a stretch adds to the digests: number of ids, their decimals, its decoded text. Bytes
        # of one character always belong to one stretch, so stretches decode one by one.
        known = Remembered()

        def part(stretch: str) -> tuple[int, str, str]:
            ids = model.fresh_ids(stretch)
            shown = "".join(model.spelled(ids))
            return known.keep(stretch, (len(ids), ",".join(map(str, ids)), shown))

        for batch in T.slices(batches):
            counts, ids, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                get = known.young.get
                parts = [get(s) or known.get(s) or part(s) for s in model.stretches(text or "")]
                counts.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest())
                shown = "".join([p[2] for p in parts])[1:]
                decoded.append(hashlib.sha256(shown.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _digests(path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


class Arrays:
    """Ids of whole texts as arrays; those of short stretches are remembered."""

    def __init__(self, model: Pieces, kind: np.dtype):
        self.model, self.kind = model, kind
        self.known = Remembered()

    def _stretch(self, stretch: str) -> np.ndarray:
        found = self.known.get(stretch)
        if found is None:
            found = self.known.keep(stretch, np.array(self.model.fresh_ids(stretch), self.kind))
        return found

    def ids(self, text: str | None, *more: int) -> np.ndarray:
        """The ids of ``text``, followed by ``more``."""
        parts = [self._stretch(s) for s in self.model.stretches(text or "")]
        return np.concatenate([*parts, np.array(more, self.kind)])


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(load(path), np.dtype(np.int32))
        for batch in T.slices(batches):
            ids = [arrays.ids(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, listed], names=[*batch.schema.names, "ids"]
            )

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of the text; replaces a column of that name."""
    docs = docs.drop("ids")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_ids(path), f"{kept}, ids array<int>")


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            shown = [None if x is None else model.decode(x) for x in batch.column("ids").to_pylist()]
            shown = pa.array(shown, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, shown], names=[*batch.schema.names, "decoded"]
            )

    return run


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of its column ``ids``; null ids give null."""
    rows = rows.drop("decoded")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_texts(path), f"{kept}, decoded string")
