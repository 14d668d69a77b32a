"""Decontamination against a brute-force scan, for several window lengths."""

import random
import re

import pytest

from citystream.llm import common, decontaminate

WORD = re.compile(decontaminate.WORD)


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(docs, items, n):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(n, len(w))
        for i in range(len(w) - m + 1) if w else ():
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i:i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    found |= {str(x) for x in own if x is not None}
        out.append((doc, len(w), len(hit), len(found), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, n):
    d = spark.createDataFrame([(*r, 0, 0) for r in docs], "doc_id long, text string, n int, words int")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, len int")
    return sorted(((r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in decontaminate.contamination(d, b, n).collect()), key=str)


@pytest.mark.parametrize("n,shuffled", [(10, False), (10, True), (4, False), (1, False)])
def test_equals_brute_force(spark, monkeypatch, n, shuffled):
    if shuffled:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    rnd = random.Random(n)
    vocab = ["a", "b", "Ab", "É", "é", "x9", "漢字", "İ", "ΑΣ", "q"]
    say = lambda k: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(k))
    items = [(i, say(rnd.choice([3, 9, 10, 11, 25, 40]))) for i in range(12)] + [(3, say(15)), (None, say(12)), (50, None), (51, " ., "), (52, "a b")]
    docs = [(i, say(rnd.randrange(0, 60))) for i in range(40)]
    for i in range(40, 70):
        w = (items[rnd.randrange(12)][1]).upper().split()
        a = rnd.randrange(len(w))
        docs.append((i, say(rnd.randrange(5)) + " " + "; ".join(w[a:a + rnd.randrange(2, 30)]) + " " + say(3)))
    docs += [(1, None), (None, ""), (70, items[4][1] * 3), (70, items[4][1] * 3), (None, items[5][1]), (71, "a " * 3000)]
    assert run(spark, docs, items, n) == brute(docs, items, n)


def test_many_windows_are_not_broadcast(spark, monkeypatch, tmp):
    """Windows counted too many go by shuffle, also where Spark sizes them as few."""
    plans, cut = [], decontaminate.cut
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string").write.parquet(tmp + "/items")
    items = spark.read.parquet(tmp + "/items")  # of a file Spark knows the size
    found = decontaminate.contamination(items.withColumnRenamed("item_id", "doc_id"), items)
    assert [(r.n_words, r.n_hit, r["items"]) for r in found.collect()] == [(12, 12, ["1"])]
    _, kept, resolved = plans
    assert not re.findall(r"BroadcastHashJoin \[(?:len|win)", kept + resolved)
    assert re.findall(r"SortMergeJoin \[(len|win)", kept + resolved)[:2] == ["len", "win"]


def test_every_shared_window_keeps_a_hash_at_one_place(spark):
    """Ties within a window: both sides keep the last of equal hashes."""
    items = [(1, "a a a a a a a a a a a a b")]
    docs = [(1, "c a a a a a a a a a a d"), (2, "a a a a a a a a a"), (3, "x a a a a a a a a a b")]
    assert run(spark, docs, items, 10) == brute(docs, items, 10)


def test_empty_tables(spark):
    docs = [(1, "a b c")]
    assert run(spark, docs, [], 10) == [(1, 3, 0, 0, (), False)]
    assert run(spark, [], [(1, "a b c")], 10) == []


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    plan = decontaminate._hashed(decontaminate.stretches(decontaminate.tokenized(d, "doc_id", "text"), 10), 10, [3])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lower_case_only_ascii(spark):
    rows = ["ABC xyz", "ÀB\u212a İΣ", None, ""]
    df = spark.createDataFrame([(r,) for r in rows], "t string").select(common.ascii_lower(__import__("pyspark").sql.functions.col("t")))
    assert [r[0] for r in df.collect()] == ["abc xyz", "Àb\u212a İΣ", None, ""]


@pytest.mark.parametrize("stretch", [7, 64])
def test_short_stretches_change_nothing(spark, monkeypatch, stretch):
    monkeypatch.setattr(decontaminate, "STRETCH", stretch)
    test_equals_brute_force(spark, monkeypatch, 10, False)
    test_equals_brute_force(spark, monkeypatch, 4, True)


def test_long_texts_wholly_hit(spark):
    """60,000 hit words in one text; 300,000 in one without a hit."""
    item = " ".join(f"w{i}" for i in range(500))
    clean = "x y z " * 100_000
    out = run(spark, [(1, f"{item} " * 120), (2, clean), (3, clean + " ".join(f"w{i}" for i in range(10)))], [(7, item)], 10)
    assert out == [(1, 60_000, 60_000, 1, ("7",), True), (2, 300_000, 0, 0, (), False), (3, 300_010, 10, 1, ("7",), True)]


def test_wide_sides_are_not_broadcast(spark):
    df = spark.createDataFrame([(1, "x" * 3000, ["y" * 3000])], "a long, b string, c array<string>")
    assert common.small(df, 1, 7000) and not common.small(df, 1, 5900) and not common.small(df.union(df), 1) and common.small(df.limit(0), 0, 0)
