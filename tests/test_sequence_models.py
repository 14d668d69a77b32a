"""Chunk-split relational detectors vs the sequential models on random data.

Small chunk and bucket sizes force runs, segments and timers to cross many
chunk/bucket boundaries.
"""

from __future__ import annotations

import random

import models
import pytest
from pyspark.sql import functions as F
from citystream.operators import bunching, detectors
from helpers import frame, ts

M_PER_DEG = 6_371_000 * 3.141592653589793 / 180


def _signals(seed: int, n: int = 400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        w = rnd.choice([None, 100.0, 180.0, 181.0, 250.0, 300.0, 200.0])
        rows.append({"junction_id": rnd.choice(["J1", "J2", None]), "zone": "Z", "avg_wait_sec": w,
                     "t": i * rnd.choice([1, 30, 600, 4000]) / 10.0 + i})
    rows.sort(key=lambda r: r["t"])
    return rows


def test_gridlock_matches_model(spark):
    total = 0
    for seed in range(3):
        rows = _signals(seed)
        df = frame(spark, rows, "junction_id string, zone string, avg_wait_sec double")
        for chunk in (60, 3600):
            got = sorted(r.event_id for r in detectors.gridlock_alerts(df, chunk_seconds=chunk).collect())
            want = sorted(models.gridlock([dict(r, event_id=i) for i, r in enumerate(rows)]))
            assert got == want, (seed, chunk)
            total += len(want)
    assert total > 10


def _gps(seed: int, n: int = 300):
    rnd = random.Random(seed)
    rows, t = [], 0.0
    for i in range(n):
        t += rnd.choice([5, 40, 200, 900])
        bus = rnd.choice(["A", "B", "C", "D"])
        route = "R1" if bus in "AB" or rnd.random() < 0.3 else "R2"
        off = rnd.choice([0, 60, 120, 190, 260, 400, 5000])
        lat = None if rnd.random() < 0.03 else 12.0 + off / M_PER_DEG
        lon = 77.0 + rnd.choice([0, 0, 100, 30000]) / M_PER_DEG
        rows.append({"bus_id": bus, "route_id": route, "lat": lat, "lon": lon, "t": t})
    return rows


def round_ratio_py(elapsed_ms):
    return round(elapsed_ms / 60000, 1)


@pytest.mark.parametrize("fine,coarse", [(64, 4096), (1, 3)])
def test_bunching_matches_model(spark, monkeypatch, fine, coarse):
    monkeypatch.setattr(bunching, "FINE_SPAN", fine)
    monkeypatch.setattr(bunching, "COARSE", coarse)
    total = 0
    for seed in range(3):
        rows = _gps(seed)
        df = frame(spark, rows, "bus_id string, route_id string, lat double, lon double")
        seq = []
        for i, r in enumerate(rows):
            tt = ts(r["t"])
            seq.append(dict(r, event_id=i, ts_ms=int(tt.replace(tzinfo=__import__("datetime").timezone.utc)
                                                      .timestamp() * 1000)))
        for dur, bucket, chunk, tchunk in ((300, 120, 60, 300), (1200, 3600, 3600, 3600),
                                           (300, None, 3600, 86_400)):
            want = sorted((e, a, b, el) for e, a, b, _, el in models.bunching(seq, duration_ms=dur * 1000))
            got = sorted((r.event_id, r.bus_a, r.bus_b, r.elapsed) for r in bunching.bunching_alerts(
                df, duration_sec=dur, bucket_seconds=bucket, chunk_seconds=chunk, timer_chunk_seconds=tchunk)
                .withColumn("elapsed", F.col("minutes_close")).collect())
            want = sorted((e, a, b, round_ratio_py(el)) for e, a, b, el in want)
            assert got == want, (seed, dur, bucket, chunk)
            total += len(want)
    assert total > 10


def test_one_wild_clock_keeps_candidates_few(spark):
    rows = _gps(1)
    wild = [{**rows[0], "lat": 12.0, "lon": 77.0, "t": -1.7e9}] + rows
    width = [bunching.time_extent(frame(spark, r, "bus_id string, route_id string, lat double, lon double"))[2] for r in (rows, wild)]
    assert width[1] <= 2 * width[0]
    cols = ("event_id", "bus_a", "bus_b")
    got = [sorted((r.event_id - n, r.bus_a, r.bus_b) for r in bunching.bunching_alerts(
        frame(spark, x, "bus_id string, route_id string, lat double, lon double")).select(*cols).collect()) for n, x in enumerate((rows, wild))]
    seq = [dict(r, event_id=i, ts_ms=int(r["t"] * 1000)) for i, r in enumerate(wild)]
    assert got[1] == sorted((e - 1, a, b) for e, a, b, *_ in models.bunching(seq))
