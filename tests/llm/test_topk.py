"""Ball-tree search against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from citystream.llm import topk


def brute(rows, k):
    import math

    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in sorted(ok, key=lambda r: r[1], reverse=True) if i % 10 == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("leaf,shard", [(128, 1 << 17), (4, 40)])
def test_equals_brute_force(spark, monkeypatch, leaf, shard):
    monkeypatch.setattr(topk, "LEAF", leaf)
    rnd = random.Random(leaf)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)], 0) for i in range(300)]
    rows += [(i, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0], 0) for i in range(300, 360)]  # ties
    rows += [(i, [1.0, 2.0], 0) for i in (400, 410, 411)] + [(420, [1e9] * 6, 0), (421, [-3e8] * 6, 0), (430, [], 0), (431, [], 0)]
    rows += [(500, None, 0), (510, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (520, [float("nan")] * 6, 0), (530, [float("inf")] * 6, 0), (None, [1.0] * 6, 0)]
    rows += [(7, [9.0] * 6, 0), (7, [9.0] * 6, 0), (10, [9.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    out = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, 10, shard_rows=shard).collect()))
    assert out == brute(rows, 10)


def test_few_and_none(spark):
    df = spark.createDataFrame([(10, [1.0]), (11, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 10).collect()] == [(10, 1, 11, 1024 * 2048)]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 10).count() == 0
