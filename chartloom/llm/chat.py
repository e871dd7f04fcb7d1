"""Chat examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only that
reply trainable. A conversation that does not end with an assistant turn has one more example, with
nothing trainable, so that every turn stands in the last example. A turn is written as

    <|turn_start|>role
    text<|turn_end|>

and control strings inside roles and texts are escaped by a backslash after their first character,
with one more where there are backslashes already, so that no text can open or close a turn and
everything can be read back. Mask positions count code points of the example.

A conversation's turns are sorted (by turn; ties by role, then text) inside a partition dealt by
conversation and then streamed: a task holds one conversation's formatted text, not its rows. The
examples of a conversation of n turns hold some n / 2 prefixes of it; that is the expansion asked for.

Nulls: a null text or role is empty, a null turn comes first. A row with a null conv_id is in no known
conversation: it is one of its own, of one turn, so however many such rows there are, they are spread over
all tasks. Repeated rows are repeated turns. An empty table gives no example. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Strings with a meaning to this template or to common tokenizers and templates.
CONTROL = [
    "<|turn_start|>",
    "<|turn_end|>",
    "<|endoftext|>",
    "<|startoftext|>",
    "<|im_start|>",
    "<|im_end|>",
    "<s>",
    "</s>",
    "<unk>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
]
START, END = CONTROL[0], CONTROL[1]
ASSISTANT = "assistant"
FLUSH_CHARS = 4 << 20

_RAW = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    return _RAW.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _unrole(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends."""
    opening, body = f"{START}{_role(role)}\n", escape(text)
    return f"{opening}{body}{END}\n", len(opening), len(opening) + len(body)


def read_turns(example: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted example."""
    turns = []
    for part in example.split(START)[1:]:
        role, _, rest = part.partition("\n")
        if not rest.endswith(f"{END}\n"):
            raise ValueError("a turn without its end")
        turns.append((_unrole(role), unescape(rest[: -len(END) - 1])))
    return turns


_COLUMNS = ["conv_id", "example", "n_turns", "text", "loss_start", "loss_stop"]


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    chars = 0
    conv, context, turns, example, open_ = None, "", 0, 0, False
    kind = None

    def emit(text, start, stop):
        nonlocal chars, example
        rows.append((conv, example, turns, text, start, stop))
        example, chars = example + 1, chars + len(text)

    def batch():
        nonlocal rows, chars
        columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in _COLUMNS]
        types = [kind, pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        rows, chars = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_COLUMNS
        )

    begun = False
    for incoming in batches:
        kind = incoming.schema.field("conv_id").type
        for conv_id, role, text in zip(
            *(incoming.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True
        ):
            if not begun or conv_id is None or conv_id != conv:
                if open_:
                    emit(context, None, None)
                conv, context, turns, example, open_, begun = conv_id, "", 0, 0, False, True
            role, text = role or "", text or ""
            turn, start, stop = write_turn(role, text)
            before = len(context)
            context += turn
            turns += 1
            open_ = role != ASSISTANT
            if not open_:
                emit(context, before + start, before + stop)
            if chars >= FLUSH_CHARS:
                yield batch()
    if open_:
        emit(context, None, None)
    if rows:
        yield batch()


def expand(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (0, 1, ...), n_turns in it, text, and the trainable
    span [loss_start, loss_stop), null where nothing is. A conversation's examples are neighbours,
    in order, in one partition."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = conversations.select("conv_id", "turn", "role", "text")
    lone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    dealt = turns.repartition("conv_id", lone).sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(
        _expand,
        f"conv_id {kind}, example int, n_turns int, text string, loss_start long, loss_stop long",
    )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    done: list[tuple] = []
    now = None
    kind = None

    def finish():
        conv, last, loss, digest, chars, n = now
        turns = read_turns(last)
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        done.append(
            (conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), loss, digest.hexdigest(), chars, n)
        )

    def batch():
        columns = [list(c) for c in zip(*done, strict=True)] or [[] for _ in names]
        done.clear()
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    for incoming in batches:
        kind = incoming.schema.field("conv_id").type
        for conv, example, text, start, stop in zip(
            *(incoming.column(c).to_pylist() for c in ("conv_id", "example", "text", "loss_start", "loss_stop")),
            strict=True,
        ):
            if example == 0:
                if now is not None:
                    finish()
                now = [conv, "", 0, hashlib.sha256(), 0, 0]
            now[1], now[4], now[5] = text, now[4] + len(text), now[5] + 1
            if start is not None:
                reply = unescape(text[start:stop])
                now[2] += len(reply)
                now[3].update(reply.encode())
        yield batch()
    if now is not None:
        finish()
        yield batch()


def report(examples: DataFrame) -> DataFrame:
    """What ``expand`` wrote, read back per conversation: its turns from the last example, its
    trainable text from the spans of all, and formatted_chars, the code points of all examples.
    To be applied to the output of ``expand`` as it comes, whose order it relies on."""
    kind = examples.schema["conv_id"].dataType.simpleString()
    return examples.select("conv_id", "example", "text", "loss_start", "loss_stop").mapInArrow(
        _read_back,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_examples long",
    )


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The turns plus conversation -7, whose texts are control strings."""
    schema = conversations.select("conv_id", "turn", "role", "text").schema
    text = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit(text).alias("text"),
    )
    probe = probe.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    return conversations.select(*schema.names).unionByName(probe)
