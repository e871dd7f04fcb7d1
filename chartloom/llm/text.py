"""Words of whole texts as arrays: spans, hashes and windows over a slice of many texts at once.

A word is a run of bytes other than space and 0x09 to 0x0D. In UTF-8 these bytes never occur inside
another character, so texts are cut and hashed as bytes, without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), _BASE, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


class Words:
    """The words of consecutive texts; ``kind`` tells which bytes words are made of.

    ``data``: bytes of all texts; ``edges``: where each text begins, and the end; ``starts`` and
    ``ends``: bytes of each word; ``first``: each text's first word, and the number of words.
    """

    def __init__(self, data: np.ndarray, edges: np.ndarray, kind: np.ndarray = _IN_WORD):
        self.data, self.edges = data, edges
        inside = kind[data]
        if len(data):
            opens, closes = inside.copy(), inside.copy()
            opens[1:] &= ~inside[:-1]
            closes[:-1] &= ~inside[1:]
            cuts = edges[(edges > 0) & (edges < len(data))]
            opens[cuts] = inside[cuts]
            closes[cuts - 1] = inside[cuts - 1]
            self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.inside = inside
        self.first = np.searchsorted(self.starts, edges)
        self.counts = np.diff(self.first)

    def hashes(self, lower_ascii: bool = False) -> np.ndarray:
        """64 bits per word, from its bytes alone."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        data = self.data[self.inside]
        if lower_ascii:
            data = np.where((data >= 65) & (data <= 90), data + 32, data)
        lengths = self.ends - self.starts
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(len(data)) - np.repeat(offsets, lengths)
        value = (data.astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
        return mix(np.add.reduceat(value, offsets) ^ lengths.astype(np.uint64))

    def of_text(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words within one text."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= size)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of one number per byte over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.edges[1:]] - total[self.edges[:-1]]

    def sum_words(self, flags: np.ndarray) -> np.ndarray:
        """Sum of one number per word over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.first[1:]] - total[self.first[:-1]]


def window_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """64 bits for the ``size`` consecutive words from each of ``at``."""
    value = np.zeros(len(at), np.uint64)
    for i in range(size):
        value = (value ^ hashes[at + i]) * np.uint64(_BASE)
        value ^= value >> np.uint64(29)
    return mix(value)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and edges of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[edges[0] : edges[-1]], edges - edges[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``size`` bytes of text, one text at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def words_of(batch: pa.RecordBatch, column: str = "text", kind: np.ndarray = _IN_WORD) -> Words:
    return Words(*texts(batch.column(column)), kind)


#: Letters and digits: ASCII ones, and every character beyond ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
