"""K2-treap search against brute force over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from citystream.llm import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall(text.translate(LOWER)) if text else []


def brute(docs, items, k):
    counted = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    total_docs, total_terms = len(counted), sum(n for *_, n in counted)
    holding = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c, n in counted:
            m = 50 + 50 * n * total_docs // total_terms
            s = sum(math.floor(1000 * math.log((2 * total_docs + 2) / (2 * holding[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard,block", [(1 << 14, 1 << 22), (37, 300)])
def test_equals_brute_force(spark, shard, block):
    rnd = random.Random(shard)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(400)] + ["Éa", "éA", "x1", "ÀB"]
    line = lambda n: rnd.choice([" ", ", ", "-", "\n"]).join(rnd.choice(words) for _ in range(n))
    docs = [(i, line(rnd.choice([1, 5, 40, 300]))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(1000, 1090)]  # ties beyond k
    docs += [(400, None), (401, ""), (402, " .,;"), (None, line(30)), (403, "W1 " * 5000), (7, docs[7][1]), (2 ** 62 + 1, docs[7][1]), (2 ** 62 + 3, docs[9][1])]
    items = [(i, line(12)) for i in range(9)] + [(20, docs[7][1]), (21, None), (22, "..."), (23, "nowhere"), (24, "w1 w2"), (24, "W3 w1"), (None, "éa")]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    assert found(ranked.rank(d, q, 20, shard=shard, block=block)) == brute(docs, items, 20)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    nulls = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string")
    for docs, items in ((d.limit(0), q), (d, q.limit(0)), (nulls, q), (d, q.where("false"))):
        out = ranked.rank(docs, items)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
    assert found(ranked.rank(d, q)) == brute([(1, "a b")], [(1, "a")], 50)


def test_treap_cells_hold_maxima_and_prune():
    rng = np.random.default_rng(1)
    rows, cols = np.unravel_index(rng.choice(50 * 3000, 9000, replace=False), (50, 3000))
    impact = rng.integers(1, 10 ** 6, 9000)
    treap = ranked.Treap(rows, cols, impact, 50, 3000)
    grid = np.zeros((1 << treap.height,) * 2, np.int64)
    grid[rows, cols] = impact
    for level, (mask, _, best) in enumerate(treap.levels):
        side = 1 << treap.height - level
        blocks = grid.reshape(1 << level, side, 1 << level, side).max((1, 3))
        assert sorted(best[:-1]) == sorted(blocks[blocks > 0])
    own, weights = np.array([3, 9, 41]), np.array([5000, 1, 900])
    c, s = treap.search(own, weights, 10)
    want = (grid[own].T @ weights)
    assert dict(zip(c.tolist(), s.tolist())) == {i: w for i, w in enumerate(want.tolist()) if w >= sorted(want)[-10]}
