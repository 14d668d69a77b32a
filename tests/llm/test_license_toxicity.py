"""Licence scan on a small tree and against a dense computation; toxicity on held-out labels."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from citystream.llm import license, toxicity

GPL = "This work is licensed under the GNU General Public License, version 3."
APACHE = "Licensed under the Apache License, Version 2.0."


def files(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "path string, text string, license int")


def test_inheritance_from_the_nearest_directory(spark):
    rows = [("a/LICENSE", GPL), ("a/x.py", "code"), ("a/b/c/y.py", "code"), ("a/b/LICENSE.txt", "# " + APACHE), ("a/own.py", "# Released under the MIT License.\ncode"),
            ("d/z.py", "code"), ("top.py", None), (None, "code"), ("a/b/z.py", None), ("a/b/z.py", None), ("ab/w.py", "code"), ("d/long.py", "mit " * 50000)]
    out = {(r.path, r.license, r.origin, r.inherited_from) for r in license.scan(files(spark, rows)).collect()}
    assert out == {
        ("a/LICENSE", "GPL-3.0", "own", None), ("a/x.py", "GPL-3.0", "inherited", "a"), ("a/b/c/y.py", "Apache-2.0", "inherited", "a/b"),
        ("a/b/LICENSE.txt", "Apache-2.0", "own", None), ("a/own.py", "MIT", "own", None), ("d/z.py", None, None, None),
        ("top.py", None, None, None), (None, None, None, None), ("a/b/z.py", "Apache-2.0", "inherited", "a/b"), ("ab/w.py", None, None, None),
        ("d/long.py", None, None, None)}
    assert license.scan(files(spark, rows)).count() == len(rows)
    assert license.scan(files(spark, rows).limit(0)).count() == 0


def test_root_licence_reaches_all(spark):
    out = license.scan(files(spark, [("COPYING", GPL), ("q/r/s.txt", "x"), ("t.txt", "y")])).collect()
    assert {r.license for r in out} == {"GPL-3.0"}


def test_scores_equal_dense_cosines(spark):
    model, rnd = license.Model(), random.Random(4)
    pool = [w for _, t in license.TEMPLATES for w in t.split()] + ["extra", "words", "mit"]
    lines = [" ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12))) for _ in range(300)]
    lines += [t[:len(t) * rnd.randrange(5, 10) // 10] for _, t in license.TEMPLATES] + [t + " extra" for _, t in license.TEMPLATES]

    def best(line):
        a = {t: n * model.weights.get(t, model.unseen) for t, n in license._terms(line).items()}
        found = []
        for (i, name, norm) in model.norms:
            dot = sum(a.get(t, 0) * w for t, j, w in model.postings if j == i)
            if a and (c := dot / math.sqrt(norm * sum(x * x for x in a.values()))) >= model.threshold:
                found.append((-round(c, 9), name))
        return min(found) if found else None

    df = spark.createDataFrame([(x, x) for x in lines], "line_id string, line string")
    possible = {r.line for r in license.candidate_lines(df.select("line_id"), F.array("line_id"), model).collect()}
    found = {r.line_id: (-round(r.score, 9), r.license) for r in license.scores(df, model).collect()}
    for line in set(lines):
        assert found.get(line) == best(line)
        assert line in possible or best(line) is None


MIT_NOTICE = license.WHOLE[0][1]
GPL_HEADER = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License "
              "as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n")


def wrap(text, width, mark=""):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(mark + line.rstrip())
            line = ""
        line += w + " "
    return "\n".join([*out, mark + line.rstrip()])


def test_wrapped_headers_and_whole_texts(spark):
    mit = MIT_NOTICE.removeprefix("MIT License ")
    paragraphs = re.sub("(conditions: |Software[.] )(?=The above|THE SOFT)", lambda m: m[0].strip() + "\n *\n * ", mit)
    rows = [("g/a.py", GPL_HEADER + "import os\n"), ("g/b.py", "#!/usr/bin/env python\n#\n" + GPL_HEADER + "\nimport os\n"),
            ("m/a.c", "/*\n * Copyright (c) 2020 A. Body\n *\n" + "\n".join(wrap(p, 70, " * ") for p in paragraphs.split("\n *\n * ")) + "\n */\nint x;\n"),
            ("l/LICENSE", wrap("MIT License Copyright (c) 2021 Somebody " + mit, 72)), ("l/x.py", "code"),
            ("b/LICENSE", wrap("BSD 3-Clause License Copyright (c) 2021, Somebody All rights reserved. " + license.WHOLE[1][1], 72)),
            ("i/LICENSE.md", "ISC License\n\nCopyright 2020 Me\n\n" + wrap(license.WHOLE[2][1], 60)), ("n/a.py", "# licence to kill\nx = 1\n")]
    out = {r.path: (r.license, r.origin) for r in license.scan(files(spark, rows)).collect()}
    assert out == {"g/a.py": ("GPL-3.0", "own"), "g/b.py": ("GPL-3.0", "own"), "m/a.c": ("MIT", "own"), "l/LICENSE": ("MIT", "own"), "l/x.py": ("MIT", "inherited"),
                   "b/LICENSE": ("BSD-3-Clause", "own"), "i/LICENSE.md": ("ISC", "own"), "n/a.py": (None, None)}


def test_blocks_equal_a_walk_over_lines(spark):
    """Runs up to a blank line and leading comments, against a line by line model."""
    marks = re.compile(license.MARKS.removeprefix("(?m)"))
    rnd = random.Random(2)
    texts = ["\n".join(rnd.choice(["", "#", "# a b", "x = 1", " * c", "/* d", "*/", "// e f", "  ", "-- g", "<!-- h", "i # j"]) for _ in range(rnd.randrange(9)))
             for _ in range(200)]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select("text", license.blocks(F.col("text")).alias("b")).collect()
    for r in found:
        bare = [marks.sub("", x, count=1) for x in r.text.split("\n")]
        runs, run = set(), []
        for x in [*bare, ""]:
            if x.strip(" "):
                run.append(x)
            elif run:
                runs.add(" ".join(run).strip())
                run = []
        head = []
        for x, plain in zip(r.text.split("\n")[:-1], bare):
            if not re.match(r"[ \t]*(#|//|/\*|\*|--|;|%)", x):
                break
            head.append(plain)
        want = runs | {" ".join(head).strip()} | {x.strip() for x in r.text.split("\n")}
        assert {x.strip() for x in r.b} - {""} == want - {""}, r.text


def test_prefix_tree():
    words = ["a", "ab", "abc", "b.c", "bd"]
    found = re.compile(license.prefix_tree(words) + r"\Z")
    assert [w for w in [*words, "", "abcd", "b", "bxc", "d"] if found.match(w)] == words


def test_no_python_in_the_plan(spark):
    plan = license.scan(files(spark, [("a/LICENSE", GPL)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def labelled(spark):
    sf = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_labels(labelled):
    docs, labels = labelled
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0").select("doc_id", "toxic"), toxicity.document_chain())
    # With so few labels only English words are frequent enough to be learned.
    held = (toxicity.predict(docs.where("lang = 'en'"), chain).join(labels.where("doc_id % 2 = 1"), "doc_id")
            .selectExpr(f"p_toxic >= {chain.threshold} AS said", "toxic = 1 AS truth").toPandas())
    assert (held.said & ~held.truth).sum() <= 2
    assert (held.said & held.truth).sum() >= 0.8 * held.truth.sum()


def test_chain_feeds_earlier_probabilities(labelled):
    docs, labels = labelled
    chain = toxicity.train(docs, labels.select("doc_id", "toxic"), toxicity.document_chain())
    n = 1 + len(chain.vocabulary)
    assert [len(w) for w in chain.weights] == [n, n + 1, n + 2]
    assert (toxicity.train(docs, labels.select("doc_id", "toxic"), toxicity.document_chain()).weights[2] == chain.weights[2]).all()


def test_threshold():
    p, y = np.array([0.9, 0.8, 0.7, 0.2, 0.2]), np.array([1, 1, 1, 0, 1])
    assert toxicity.best_threshold(p, y) == pytest.approx(0.45)
    assert toxicity.best_threshold(np.full(5, 0.1), y) == 0.5
    assert toxicity.best_threshold(p, np.zeros(5)) == 0.5


def test_edges(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame([(1, None, 0), (None, "you idiot moron scum trash", 0), (2, "", 0), (2, "", 0)], "doc_id long, text string, p_toxic int")
    out = toxicity.predict(odd, toxicity.train(docs, labels.select("doc_id", "toxic"), toxicity.document_chain())).collect()
    assert len(out) == 4 and all((r.p_toxic > 0.9) == (r.doc_id is None) for r in out)
    none = toxicity.judge(odd, labels.limit(0)).collect()
    assert len(none) == 4 and not any(r.toxic for r in none)
    assert toxicity.judge(odd.limit(0), labels).count() == 0


def test_held_out_labels_of_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0").select("doc_id", "toxic"), toxicity.document_chain())
    held = (toxicity.predict(docs, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
            .selectExpr("lang", f"p_toxic >= {chain.threshold} AS said", "toxic = 1 AS truth").toPandas())
    for lang, own in held.groupby("lang"):
        hits = (own.said & own.truth).sum()
        assert hits >= 0.75 * own.truth.sum(), lang
        assert hits >= 0.85 * own.said.sum(), lang


def test_null_and_foreign_labels_train_nothing(spark, labelled):
    """Unmarked toxic documents are no negatives; labels without a document take no place in the sample."""
    docs, labels = labelled
    marked = labels.select("doc_id", "toxic")
    half = marked.withColumn("toxic", F.expr("if(toxic = 1 AND doc_id % 3 > 0, NULL, toxic)"))
    foreign = spark.range(10 ** 9, 10 ** 9 + 3000).selectExpr("id AS doc_id", "cast(0 AS int) AS toxic")
    want = toxicity.train(docs, half.where("toxic IS NOT NULL"), toxicity.document_chain())
    found = toxicity.train(docs, half.unionByName(foreign), toxicity.document_chain(), max_train=half.where("toxic IS NOT NULL").count())
    assert found.vocabulary == want.vocabulary and found.threshold == want.threshold
    assert all((a == b).all() for a, b in zip(found.weights, want.weights))
    assert not toxicity.train(docs, marked.withColumn("toxic", F.lit(None).cast("int")), toxicity.document_chain()).weights


def test_an_id_with_several_texts_trains_once(spark):
    texts = [(i, f"calm words of day {i}") for i in range(60)] + [(i, f"zzvile zzrude {i}") for i in range(100, 130)]
    docs = spark.createDataFrame(texts + [(1, f"another text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in texts] + [(1, 0), (101, 0), (None, 1)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels, toxicity.document_chain())
    assert {"zzvile", "zzrude"} <= set(chain.vocabulary) and "another" not in chain.vocabulary
    said = chain.predict(["zzvile zzrude person", "calm words"])[:, -1]
    assert said[0] > chain.threshold > said[1]


def test_fit_equals_dense_newton():
    rng = np.random.default_rng(0)
    x = (rng.random((3000, 12)) < 0.2).astype(float)
    y = (rng.random(3000) < toxicity.sigmoid(x @ rng.normal(0, 2, 12) - 1)).astype(float)
    starts = np.append(0, np.cumsum(x.sum(1))).astype(np.int64)
    times = rng.integers(1, 4, 3000).astype(float)
    design = toxicity.Design(starts, np.nonzero(x)[1], 12, times, np.zeros((3000, 0), np.float32))
    w = design.fit(np.arange(3000), y)
    full = np.column_stack([np.ones(3000), x])
    ridge = np.append(1e-3, np.full(12, toxicity.RIDGE))
    assert np.abs(full.T @ (times * (y - toxicity.sigmoid(full @ w))) - ridge * w).max() < 1e-2


def test_near_copies_equal_components(spark):
    rnd = random.Random(4)
    prints = [rnd.getrandbits(64) for _ in range(300)]
    prints += [p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5))) for p in prints for _ in range(2)]
    signed = sorted({p - (p >> 63 << 64) for p in prints})
    root = {p: p for p in signed}
    for a in signed:
        for b in signed:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    assert {r.fp: r.root for r in toxicity.near_copies(df, 3).collect()} == root
    assert toxicity.near_copies(df.limit(0), 3).count() == 0


def test_stems():
    assert toxicity.stems(["abcdx", "abcdy", "abz", "ab"]) == {"abc*", "abcd*"}
    assert toxicity.stems(["abcdx", "abcdy", "xyz1", "xyz2"], frozenset(["xyz"])) == {"xyz*"}
    assert not toxicity.stems(["word"])


def test_near_copies_count_once(spark):
    rnd = random.Random(3)
    noise = ["".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(800)]
    page = " ".join(rnd.choice(noise[:400]) + "qu" for _ in range(1500))
    rows = [(i, f"{page} tail{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}", 1) for i in range(40)]
    # The words of a rare language: 12 of 440 documents, each with two words of one stem.
    for i in range(40, 440):
        bad = i % 33 == 0
        own = rnd.sample(noise, 40) + (["zhu" + w for w in rnd.sample(noise, 4)] if bad else [])
        rows.append((i, " ".join(own), int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"), {"toxic": F.col("toxic") > 0})
    assert "zhu*" in chain.vocabulary
    assert not any(w.rstrip("*").endswith("qu") or w.startswith("tail") for w in chain.vocabulary)
