"""Packed token rows: best-fit-decreasing with capacity search in a segment tree.

Texts become ids of a byte-level vocabulary (a closing id after each), documents longer than a row are split into full rows and
a rest, and the pieces are packed into rows of ``LENGTH`` ids: longest piece first, each into the open
row with the least room that still takes it. Rows are counted by room in a segment tree, so that the
search takes log2(LENGTH) steps however many rows are open.

Packing goes on inside windows of ``WINDOW_IDS`` ids of a partition as it is read: nothing is shuffled,
memory is bounded, and a window holds so many rows that it fills them as well as one over all
documents would. A window is written in blocks: a matrix of ids (little-endian unsigned 16 or 32 bits,
row by row, padded), the ends of the segments of each row (cu_seqlens) and the positions, which begin
again at 0 with each segment. Segments name document and offset, so that every document can be put
together again from the rows.

Nulls: a null text is empty, and an empty text is one closing id. A null doc_id is carried. Repeated
rows are packed each. An empty table gives no block. Other columns are not read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm import text as T

LENGTH = 2048
WINDOW_IDS = 4 << 20
#: Rows of a matrix in one record.
BLOCK_ROWS = 64
#: The id after each text, free in the vocabulary.
CLOSE_ID = 50_256


class Rooms:
    """How many open rows have each amount of room, in a segment tree over the amounts."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def least(self, needed: int) -> int | None:
        """The smallest amount of room that is at least ``needed`` and that a row has."""
        at = needed + self.leaves
        if self.tree[at]:
            return needed
        while at > 1:
            if not at & 1 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Pieces of each row. Equal lengths keep their order; of rows with equal room the last that
    came to it is taken."""
    rows: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = Rooms(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = rooms.least(size)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = by_room[room].pop()
            rooms.add(room, -1)
        rows[row].append(i)
        by_room.setdefault(room - size, []).append(row)
        rooms.add(room - size, 1)
    return rows


def _split(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, offset and length of each piece."""
    parts = np.maximum(1, -(-lengths // capacity))
    doc = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    offset = number * capacity
    return doc, offset, np.minimum(capacity, lengths[doc] - offset)


def _blocks(docs: list, ids: list[np.ndarray], width: np.dtype, capacity: int) -> Iterator[dict]:
    """The packed rows of one window, ``BLOCK_ROWS`` at a time."""
    lengths = np.array([len(x) for x in ids], np.int64)
    doc, offset, size = _split(lengths, capacity)
    rows = best_fit_decreasing(size, capacity)
    for begin in range(0, len(rows), BLOCK_ROWS):
        chosen = rows[begin : begin + BLOCK_ROWS]
        matrix = np.zeros((len(chosen), capacity), width)
        position = np.zeros((len(chosen), capacity), np.uint16 if capacity <= 1 << 16 else np.uint32)
        ends, segments = [], []
        for r, row in enumerate(chosen):
            at, own = 0, [0]
            for p in row:
                n = int(size[p])
                matrix[r, at : at + n] = ids[doc[p]][offset[p] : offset[p] + n]
                position[r, at : at + n] = np.arange(n)
                segments.append((docs[doc[p]], int(offset[p]), n, begin + r))
                at += n
                own.append(at)
            ends.append(own)
        yield {
            "rows": len(chosen),
            "first_row": begin,
            "ids": matrix.tobytes(),
            "positions": position.tobytes(),
            "cu_seqlens": ends,
            "segments": segments,
        }


_loaded: dict[tuple[str, str], tiktoken.Encoding] = {}


def load(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level encoding at ``path``, once per process; the file must be on every executor."""
    if (path, pattern) not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _loaded[path, pattern] = tiktoken.Encoding(
            os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _loaded[path, pattern]


def _pack(path: str, pattern: str, capacity: int, window_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        width = np.dtype("<u2" if max(model.max_token_value, CLOSE_ID) < 1 << 16 else "<u4")
        docs: list = []
        held: list[np.ndarray] = []
        size, window = 0, 0
        kind = None

        def close_window() -> Iterator[pa.RecordBatch]:
            nonlocal docs, held, size, window
            segment = pa.struct(
                [("doc_id", kind), ("offset", pa.int64()), ("n", pa.int32()), ("row", pa.int32())]
            )
            for b in _blocks(docs, held, width, capacity):
                listed = [dict(zip(("doc_id", "offset", "n", "row"), s, strict=True)) for s in b["segments"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([window], pa.int32()),
                        pa.array([b["first_row"]], pa.int32()),
                        pa.array([b["rows"]], pa.int32()),
                        pa.array([b["ids"]], pa.binary()),
                        pa.array([b["positions"]], pa.binary()),
                        pa.array([b["cu_seqlens"]], pa.list_(pa.list_(pa.int32()))),
                        pa.array([listed], pa.list_(segment)),
                    ],
                    names=["window", "first_row", "n_rows", "ids", "positions", "cu_seqlens", "segments"],
                )
            docs, held, size, window = [], [], 0, window + 1

        for batch in T.slices(batches):
            kind = batch.schema.field("doc_id").type
            for doc, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                docs.append(doc)
                held.append(np.array([*model.encode_ordinary(text or ""), CLOSE_ID], width))
                size += len(held[-1])
                if size >= window_ids:
                    yield from close_window()
        if docs:
            yield from close_window()

    return run


def pack(
    docs: DataFrame, path: str, pattern: str, capacity: int = LENGTH, window_ids: int = WINDOW_IDS
) -> DataFrame:
    """One row per block of packed rows: partition and window it belongs to, first_row and n_rows in
    the window, ids and positions (matrices of n_rows x capacity), cu_seqlens and segments."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = docs.select("doc_id", "text").mapInArrow(
        _pack(path, pattern, capacity, window_ids),
        "window int, first_row int, n_rows int, ids binary, positions binary, "
        f"cu_seqlens array<array<int>>, segments array<struct<doc_id:{kind},offset:bigint,n:int,row:int>>",
    )
    return packed.select(F.spark_partition_id().alias("partition"), "*")
