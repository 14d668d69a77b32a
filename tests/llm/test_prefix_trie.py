"""The prefix trie against a trie built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from citystream.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below[node]) or 1
        saved[node] = sum(saved[x] for x in below[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(below[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 9, "x") for r in rows], "conv_id long, turn long, role string, text string, node int, depth string").repartition(parts)


@pytest.mark.parametrize("width", [1 << 22, 64])
def test_equals_plain_trie(spark, width):
    """Also with a full sketch: then everything is grouped exactly."""
    rnd = random.Random(width)
    said = ["hi", "yes", "nö\n", "", None]
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(said)) for c in range(0, 420) if c != 300 for t in range(rnd.randrange(1, 9))]
    rows += [(c, t, "user", f"copy {t}") for c in range(500, 560) for t in range(40)]  # one long conversation, copied
    rows += [(c, t, "user", f"copy {t}") for c in range(520, 530) for t in range(40, 45)]
    rows += [(2 ** 62 + 8, 0, "user", "far"), (2 ** 62 + 8, None, None, "first"), (2 ** 62 + 8, None, "a", "b"), (2 ** 62 + 9, 1, "ab", ""), (2 ** 62 + 10, 1, "a", "b"), (2 ** 62 + 11, 1, "", "ab")]
    rows += [(None, 0, "user", "no id"), (7, 50, "x", "twice"), (7, 50, "x", "twice")]
    assert found(prefix_trie.trie(table(spark, rows), width=width)) == brute(rows)


def test_long_conversation_over_many_tasks(spark):
    rows = [(200, t, "user", f"turn {t % 7}") for t in range(3000)] + [(c, t, "user", f"turn {t % 7}") for c in range(201, 206) for t in range(2500)] + [(1, 0, "u", "t")]
    assert found(prefix_trie.trie(table(spark, rows, 8))) == brute(rows)


def test_empty_and_single(spark):
    empty = table(spark, [(1, 1, "a", "b")]).limit(0)
    assert prefix_trie.trie(empty).columns == COLUMNS and prefix_trie.trie(empty).count() == 0
    assert prefix_trie.trie(table(spark, [(None, 1, "a", "b")])).count() == 0
    one = [(0, 1, "a", "b")]
    assert found(prefix_trie.trie(table(spark, one))) == brute(one)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    digests = [rng.bytes(16) for _ in range(300)]
    times = rng.integers(0, 4, 300)
    sketch = prefix_trie.Sketch(1 << 10)
    for r in range(3):
        batch = [d for d, n in zip(digests, times) if n > r]
        sketch.add(pa.array(batch, pa.binary()))
    estimate = sketch.estimate(pa.array(digests, pa.binary()))
    assert (estimate >= np.minimum(times, 2)).all() and (estimate == np.minimum(times, 2)).mean() > 0.95
