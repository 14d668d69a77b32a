"""Timer kernels over many chunks at once, and the cells a radius reaches."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from helpers import frame
from models import haversine_m
from pyspark.sql import functions as F

from citystream.operators import bunching, timer


def _chunks(rnd, n, d):
    """Chunks of 1 to 40 rows on end, each with its start, carried timer and whether its first run goes on."""
    out = []
    for _ in range(n):
        start = rnd.randrange(-5, 5) * 20 * d
        ts = np.sort(np.array([start + rnd.randrange(20 * d) for _ in range(rnd.randint(1, 40))]))
        ids = np.array(rnd.sample(range(1000), len(ts)))
        preds = np.append(-1, ids[:-1])
        preds[[rnd.random() < 0.2 for _ in preds]] = -2
        out.append((start, ts, ids, preds, rnd.random() < 0.5, start - rnd.randrange(3 * d)))
    return out


@pytest.mark.parametrize("d", [1, 300, 86_400_000])
def test_many_chunks_equal_each_alone(d):
    chunks = _chunks(random.Random(d), 500, d)
    starts, ts, ids, preds, on, carried = zip(*chunks)
    firsts = np.cumsum([0, *map(len, ts[:-1])])
    every = timer.summarize_all(*map(np.concatenate, (ts, ids, preds)), firsts, np.array(starts), d)
    bounds = np.cumsum(every["cand_n"])[:-1]
    lists = {k: [v.tolist() for v in np.split(every[k], bounds)] for k in ("cand_ts", "cand_exit")}
    rows, elapsed = timer.replay_all(*map(np.concatenate, (ts, ids, preds)), firsts, np.array(starts), np.array(on), np.array(carried), d)
    got = dict(zip(rows.tolist(), elapsed.tolist()))
    want = {}
    for i, (start, t, k, p, goes_on, entered) in enumerate(chunks):
        alone = timer.summarize(t, k, p, d, start)
        for c in ("first_pred", "last_id", "has_local_start", "det_exit", "start_exit"):
            assert every[c][i] == alone[c], c
        assert lists["cand_ts"][i] == alone["cand_ts"].tolist() and lists["cand_exit"][i] == alone["cand_exit"].tolist()
        # The plain fold, row by row.
        first = entered
        for j, at in enumerate(t.tolist()):
            if (j or not goes_on) and (not j or p[j] != k[j - 1]):
                first = at
            elif at - first > d:
                want[firsts[i] + j] = at - first
                first = at
    assert got == want and len(want) > 500


def test_cells_within_hold_every_close_point(spark):
    rnd, rows = random.Random(4), []
    for _ in range(3000):
        lat = rnd.choice([rnd.uniform(-89.99, 89.99), rnd.uniform(79, 89.99), rnd.uniform(-89.99, -79), 0.0])
        lon = rnd.choice([rnd.uniform(-180, 180), 179.9999, -179.9999])
        d, brg = rnd.uniform(0, 250) / 6_371_000, rnd.uniform(0, 2 * math.pi)
        p1, l1 = math.radians(lat), math.radians(lon)
        p2 = math.asin(math.sin(p1) * math.cos(d) + math.cos(p1) * math.sin(d) * math.cos(brg))
        l2 = l1 + math.atan2(math.sin(brg) * math.sin(d) * math.cos(p1), math.cos(d) - math.sin(p1) * math.sin(p2))
        lat2, lon2 = math.degrees(p2), (math.degrees(l2) + 540) % 360 - 180
        rows.append((lat, lon, lat2, lon2, haversine_m(lat, lon, lat2, lon2)))
    df = spark.createDataFrame(rows, "lat double, lon double, lat2 double, lon2 double, dist double").where("dist <= 200")
    g = bunching.Grid(800.0)
    cells = g.cells_within(F.col("lat"), F.col("lon"), 200.0)
    got = df.select(F.size(cells).alias("n"), F.array_contains(cells, g.own_cell(F.col("lat2"), F.col("lon2"))).alias("ok")).collect()
    assert len(got) > 1000 and all(r.ok for r in got)
    assert max(r.n for r in got) <= 4 and sum(r.n for r in got) < 3 * len(got)


def test_an_event_probes_few_cells(spark):
    """What the join's probes are made into: before, 18 copies of every event, nine cells in two kinds of bucket."""
    rnd = random.Random(2)
    events = [{"route_id": "R", "bus_id": f"b{i % 40}", "lat": 52 + rnd.random() / 10, "lon": 13 + rnd.random() / 10, "t": 10 * i} for i in range(2000)]
    gps = frame(spark, events, "route_id string, bus_id string, lat double, lon double")
    probes = []
    explode = F.explode
    try:
        bunching.F.explode = lambda c: probes.append(c) or explode(c)
        bunching.close_observations(gps)
    finally:
        bunching.F.explode = explode
    assert gps.select(F.sum(F.size(probes[0]))).first()[0] < 3 * len(events)
