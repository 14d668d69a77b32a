"""Chat formatting: order of turns, escapes, loss mask."""

import random

from pyspark.sql import functions as F

from citystream.llm import chat


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    return {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(3)
    bits = ["\\", "0", "1", "2", "### ", "###", " ", "</turn>", "</turn>\n", "\n", ": ", "assistant", "é", "<", "%3A", "%", "%25"]
    rows = []
    for conv in range(40):
        for turn in range(rnd.randrange(1, 1200 if conv == 0 else 6)):
            rows.append((conv, turn, rnd.choice(["system", "user", "assistant", "a:b", "%3A</turn>", "", "assistant"]),
                         "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 12)))))
    out = run(spark, rows)
    for conv in range(40):
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert [(t.role, t.text) for t in out[conv].turns] == own
        assert out[conv].loss_text == "".join(t for r, t in own if r == "assistant")
        assert out[conv].formatted == "".join(s.text for s in out[conv].segments)
        assert out[conv].formatted.count("</turn>\n") == len(own)


def test_machine(spark):
    order = {1: "system user assistant", 2: "user assistant user", 3: "assistant user", 4: "user user", 5: "system", 6: "user bot",
             7: "user assistant system"}
    out = run(spark, [(c, i, r, "x") for c, roles in order.items() for i, r in enumerate(roles.split())])
    assert {c: r.valid for c, r in out.items()} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: False}
    assert out[4].violations == 1 and out[7].violations == 2


def test_nulls_ties_and_empty(spark):
    out = run(spark, [(1, 0, None, None), (1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "user", "q")])
    assert [(t.role, t.text) for t in out[1].turns] == [("user", "first"), ("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert out[None].n_turns == 1
    assert run(spark, []) == {}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.format_conversations(df)).select(F.size("turns"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
