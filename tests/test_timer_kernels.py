"""Chunk-split timer kernels == the plain sequential fold (pure Python)."""

from __future__ import annotations

import random

import numpy as np

from citystream.operators import timer


def fold(ts, ids, preds, d):
    out, first, last = [], None, None
    for t, i, p in zip(ts, ids, preds):
        if last is None or p != last:
            first = t
        elif t - first > d:
            out.append((i, t - first))
            first = t
        last = i
    return out


def chunked(ts, ids, preds, d, c):
    ts, ids, preds = map(np.asarray, (ts, ids, preds))
    chunks = ts // c
    order = sorted(set(chunks.tolist()))
    out, tmr, last = [], 0, None
    for ck in order:
        sel = chunks == ck
        row = timer.summarize(ts[sel], ids[sel], preds[sel], d, ck * c)
        goes_on = row["first_pred"] == last
        for k, el in timer.replay(ts[sel], ids[sel], preds[sel], d, goes_on, tmr):
            out.append((int(ids[sel][k]), el))
        tmr, last = timer.resolve(goes_on, tmr, row, d), row["last_id"]
    return out


def test_chunked_timer_equals_fold():
    rnd = random.Random(7)
    n_alerts = 0
    for trial in range(300):
        n = rnd.randint(1, 80)
        t, ts, ids, preds = 0, [], [], []
        prev = -1
        for i in range(n):
            t += rnd.choice([1, 50, 120, 299, 300, 301, 650, 4000])
            ts.append(t)
            ids.append(100 + 2 * i)
            # Predecessor is the previous close row (run continues) or not.
            preds.append(prev if rnd.random() < 0.85 else 100 + 2 * i - 1)
            prev = 100 + 2 * i
        d = rnd.choice([300, 1000])
        want = fold(ts, ids, preds, d)
        n_alerts += len(want)
        for c in (d, 2 * d, 3600, 10 ** 9):
            assert chunked(ts, ids, preds, d, c) == want, (trial, c)
    assert n_alerts > 100


def _history(rnd, n):
    t, ts, ids, preds, prev = 0, [], [], [], -1
    for i in range(n):
        t += rnd.choice([1, 50, 120, 299, 300, 301, 650, 4000])
        ts.append(t)
        ids.append(100 + 2 * i)
        preds.append(prev if rnd.random() < 0.93 else 100 + 2 * i - 1)
        prev = 100 + 2 * i
    return np.array(ts), np.array(ids), np.array(preds)


def test_composed_summaries_equal_resolving_each():
    """Any way of putting neighbours together gives the timer that they give in turn, for every timer carried in."""
    rnd = random.Random(11)
    for _ in range(300):
        ts, ids, preds = _history(rnd, rnd.randint(2, 60))
        d = rnd.choice([300, 1000])
        c = rnd.choice([d, 2 * d, 16 * d])
        parts = [(int(k), timer.summarize(ts[ts // c == k], ids[ts // c == k], preds[ts // c == k], d, int(k) * c)) for k in np.unique(ts // c)]
        start, first = parts[0][0] * c, parts[0][1]
        want = {}
        for goes_on in (False, True):
            for carried in range(start - 2 * d, start, d // 7):
                tmr, on, last = carried, goes_on, None
                for _, row in parts:
                    on = goes_on if last is None else row["first_pred"] == last
                    tmr, last = timer.resolve(on, tmr, row, d), row["last_id"]
                want[goes_on, carried] = tmr
        while len(parts) > 1:
            i = rnd.randrange(len(parts) - 1)
            parts[i:i + 2] = [(parts[i][0], timer.compose(parts[i][1], parts[i + 1][1], d, parts[i][0] * c))]
        whole = parts[0][1]
        assert (whole["first_pred"], whole["last_id"]) == (first["first_pred"], int(ids[-1]))
        assert {k: timer.resolve(k[0], k[1], whole, d) for k in want} == want


def test_scan_in_rounds_equals_one_round(spark):
    """Pass B over many levels, several pairs, one of them over a thousand chunks."""
    from pyspark.sql import functions as F

    from citystream.operators import bunching
    from citystream.session import prepare
    prepare(spark)
    rnd, d, c, rows, want = random.Random(5), 300, 1200, [], {}
    for pair, n in (("long", 3000), ("short", 30), ("one", 1)):
        ts, ids, preds = _history(rnd, n)
        tmr, last = 0, None
        for k in np.unique(ts // c).tolist():
            sel = ts // c == k
            row = timer.summarize(ts[sel], ids[sel], preds[sel], d, k * c)
            want[pair, k] = (row["first_pred"] == last, tmr)
            tmr, last = timer.resolve(row["first_pred"] == last, tmr, row, d), row["last_id"]
            rows.append(("R", pair, "x", k, *(row[x].tolist() if isinstance(row[x], np.ndarray) else row[x] for x in bunching.SUMMARY_COLUMNS)))
    summaries = spark.createDataFrame(rows, bunching.SUMMARY_SCHEMA).repartition(5)
    n_chunks = summaries.agg(F.max("_ck") - F.min("_ck") + 1).first()[0]
    assert n_chunks > 1000
    for fan_in in (4, 64, 10 ** 6):
        got = {(r._a, r._ck): (r.goes_on, r.carried) for r in bunching.timer_entries(summaries, n_chunks, d, c, fan_in).collect()}
        assert {k: v if v[0] else (False,) for k, v in got.items()} == {k: v if v[0] else (False,) for k, v in want.items()}


def test_candidates_of_a_dense_pair_are_few():
    d, c = 86_400_000, 16 * 86_400_000
    ts = np.arange(0, c, 5_000)
    row = timer.summarize(ts, np.arange(len(ts)), np.arange(len(ts)) - 1, d, 0)
    assert len(row["cand_ts"]) < 0.1 * len(ts)
