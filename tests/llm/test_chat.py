import hashlib
import random

import pytest

from chartloom.llm import chat

TURNS = "conv_id long, turn int, role string, text string"


def rows():
    draw = random.Random(9)
    bits = [*chat.CONTROL, *(c[0] + "\\" + c[1:] for c in chat.CONTROL), "\\", "<", "|>", "[", "\n", "hello ", "é🙂", "%0A", "%"]
    out = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 9)):
            text = "".join(draw.choices(bits, k=draw.randrange(12)))
            role = draw.choice(["system", "user", "assistant", "assistant", "odd\n%role" + chat.START])
            out.append((conv, turn, role, text))
    draw.shuffle(out)
    return out


def test_escaping_is_reversible():
    for _, _, role, text in rows():
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROL)
        assert chat._unrole(chat._role(role)) == role


def test_examples(spark):
    given = rows()
    examples = chat.expand(spark.createDataFrame(given, TURNS)).collect()
    convs = {}
    for conv, turn, role, text in sorted(given):
        convs.setdefault(conv, []).append((role, text))
    for conv, turns in convs.items():
        own = [e for e in examples if e.conv_id == conv]
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        ends = [*replies, *([len(turns) - 1] if turns[-1][0] != "assistant" else [])]
        assert [e.example for e in own] == list(range(len(ends)))
        for e, end in zip(own, ends, strict=True):
            assert chat.read_turns(e.text) == turns[: end + 1]
            if turns[end][0] == "assistant":
                assert chat.unescape(e.text[e.loss_start : e.loss_stop]) == turns[end][1]
            else:
                assert e.loss_start is None


def test_read_back(spark):
    given = [(1, 0, "user", None), (1, 1, "assistant", None), (2, None, None, "x"), (None, 3, "assistant", "y"), (None, 3, "assistant", "y"), (3, 1, "user", "q"), (3, 0, "assistant", "r")]
    df = chat.with_probe(spark, spark.createDataFrame(given, TURNS))
    found = chat.report(chat.expand(df)).collect()
    assert sum(r.conv_id is None for r in found) == 2
    got = {r.conv_id: r for r in found}
    probe = "</s>[INST] ok [/INST]"
    want = {
        1: [("user", ""), ("assistant", "")],
        2: [("", "x")],
        None: [("assistant", "y")],
        3: [("assistant", "r"), ("user", "q")],
        -7: [("user", probe), ("assistant", probe)],
    }
    assert set(got) == set(want)
    for conv, turns in want.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= len(whole)


@pytest.mark.parametrize("flush", [1, 1 << 20])
def test_long_conversation(spark, monkeypatch, flush):
    given = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(301)]
    df = spark.createDataFrame(given, TURNS).repartition(7)
    examples = chat.expand(df)
    assert examples.count() == 151
    assert chat.report(examples).first().n_turns == 301


def test_nothing(spark):
    assert chat.report(chat.expand(spark.createDataFrame([], TURNS))).count() == 0


def test_a_third_of_the_rows_without_a_conversation(spark, conf):
    """They are spread over the tasks, and expanded one by one. Extra columns are not in the way."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    given = [(None, 1, "assistant", "same")] * 3000 + [(i % 500, i // 500, "user", f"t{i}") for i in range(6000)]
    turns = spark.createDataFrame(given, TURNS).selectExpr("*", "'x' AS example", "1 AS n_turns", "2 AS lone")
    examples = chat.expand(turns)
    alone = examples.where("conv_id IS NULL")
    assert alone.count() == 3000 and alone.where("n_turns <> 1 OR example <> 0").isEmpty()
    spread = examples.selectExpr("conv_id", "spark_partition_id() AS p").where("conv_id IS NULL").groupBy("p").count().collect()
    assert max(r["count"] for r in spread) < 1500
    assert chat.report(examples).count() == 3500
