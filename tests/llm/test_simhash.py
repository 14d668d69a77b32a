"""SimHash: contract fingerprints, exact links and components against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from citystream.llm import common, simhash
from citystream.llm.components import components


def brute_fingerprint(text, n=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    runs = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, max_bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= max_bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


def test_fingerprint_is_the_contracts(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "É é\x1cx\x85y\u3000z a a a a a a a a", "a b c"]
    texts += [" ".join(rnd.choice("the of Ämter x y".split()) for _ in range(rnd.randrange(1, 60))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t, 3) == brute_fingerprint(t)


def test_spark_hashes_alike(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"a b c", 42)).astype(np.int64)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("max_bits,block", [(3, 4096), (3, 8), (1, 8), (2, 16), (4, 4096), (5, 32), (0, 8)])
def test_links_join_what_all_pairs_join(spark, max_bits, block):
    rnd = random.Random(max_bits * 100 + block)
    values = set()
    for _ in range(30):
        at = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 25)):
            values.add(at)
            for _ in range(rnd.randrange(0, max_bits + 3)):
                at ^= 1 << rnd.randrange(64)
    values |= {0, (1 << 64) - 1, 1, 1 << 63}
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {r.node: r.root for r in components(simhash.links(df, max_bits, block)).collect()}
    want = brute_roots(sorted(values), max_bits)
    groups, own = {}, {}
    for v in values:
        groups.setdefault(want[v], set()).add(signed(v))
        own.setdefault(found.get(signed(v), signed(v)), set()).add(signed(v))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_rows_nulls_and_repeats(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    df = spark.createDataFrame([(5, text, 1), (3, text, 2), (3, text, 2), (None, text, 3), (9, None, 4), (8, "", 5), (7, "other words", 6)],
                               "doc_id long, text string, fp int")
    out = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()]
    f = f"{brute_fingerprint(text):016x}"
    assert sorted(out, key=str) == sorted([(5, f, 3), (3, f, 3), (3, f, 3), (None, f, 3), (9, "0" * 16, 8), (8, "0" * 16, 8),
                                           (7, f"{brute_fingerprint('other words'):016x}", 7)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}}


# A chain c-b-a-d of links of 3 bits, without any other link.
CHAIN = [0x0000000800000001, 0x0000808800000003, 0x000080B800000002, 0x0000030800000005]


def test_a_replica_is_met_by_every_home():
    code = simhash.HammingCode(32)
    for order in itertools.permutations(CHAIN):
        groups = {}
        for v in order:
            for part in range(2):
                at = code.anchors(np.array([v >> 32 * part], np.uint64))[0].tolist()
                for k, anchor in enumerate(dict.fromkeys(at)):
                    groups.setdefault((part, anchor), ([], []))[k > 0].append(v)
        pairs = [x for h, o in groups.values() for x in simhash.forest(np.array(h, np.int64), np.array(o, np.int64), 3)]
        reached = {order[0]}
        for _ in CHAIN:
            reached |= {x for p in pairs if reached & set(p) for x in p}
        assert reached == set(CHAIN)


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_chain_is_one_component(spark, block):
    df = spark.createDataFrame([(signed(v),) for v in CHAIN], "fp long").coalesce(1)
    assert {r.node: r.root for r in components(simhash.links(df, 3, block)).collect()} == {v: min(CHAIN) for v in CHAIN}


def test_copies_at_anchors_are_never_broadcast(spark):
    """A fingerprint becomes up to 32 rows, which Spark sizes as one: few enough to broadcast, as it thinks, before and while it runs."""
    df = spark.createDataFrame([(signed(random.Random(i).getrandbits(64)),) for i in range(3000)], "fp long").distinct()
    found = simhash.links(df, 3)
    execution = found._jdf.queryExecution()
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) == 10 << 20
    assert "SortMergeJoin" in execution.executedPlan().toString()
    found.collect()
    assert "isFinalPlan=true" in (plan := execution.executedPlan().toString()) and "Broadcast" not in plan


@pytest.mark.parametrize("most,join", [(5, "SortMergeJoin"), (50, "BroadcastHashJoin")])
def test_a_side_counted_large_is_shuffled(spark, most, join):
    """However small Spark takes it to be."""
    df = spark.range(10)
    plan = df.join(common.bounded(df, most), "id", "left")._jdf.queryExecution().executedPlan().toString()
    assert join in plan
