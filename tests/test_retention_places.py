"""Retention by date partition, equal-position classes, SQL over named relations."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F
from test_streaming import SF, _rows, collect_to, stage, stream_of

from citystream import schemas
from citystream.operators import aggregates, history, relations, retention
from citystream.sources import testdata as td


def _dated(spark, root):
    rows = [("a", dt.datetime(2024, 1, d, h)) for d in range(1, 11) for h in (3, 9, 15)] + [("a", None), ("b", dt.datetime(2024, 1, 2, 5)), ("c", None)]
    df = spark.createDataFrame(rows, "dataset string, event_time timestamp").withColumn("id", F.monotonically_increasing_id())
    retention.write_dated(df, root)
    return df


def test_plan_and_apply_touch_the_boundary_day_only(spark, tmp):
    root = os.path.join(tmp, "data")
    df = _dated(spark, root).persist()
    plans = retention.plan(spark, root, {"a": 3, "b": 1, "c": 1})
    a, b, c = plans
    assert a.rewrite == ["2024-01-07"] and a.keep == ["2024-01-08", "2024-01-09", "2024-01-10"] and a.cutoff == dt.datetime(2024, 1, 7, 15)
    assert a.drop == [f"2024-01-0{d}" for d in range(1, 7)] + [retention.NO_DATE]
    assert b.keep == ["2024-01-02"] and not b.drop and c.drop == [retention.NO_DATE] and c.cutoff is None
    got = {r.dataset: (r.total, r.retained) for r in retention.summary(spark, root, plans).collect()}
    assert got == {"a": (31, 10), "b": (1, 1), "c": (1, 0)}
    files = lambda day: sorted(os.listdir(os.path.join(root, "dataset=a", f"date={day}")))
    before = {d: files(d) for d in a.keep}
    for _ in range(2):  # carried out again, nothing changes
        retention.apply(spark, root, retention.plan(spark, root, {"a": 3, "b": 1, "c": 1}))
        left = spark.read.parquet(root)
        want = df.where("dataset = 'b' OR (dataset = 'a' AND event_time >= timestamp'2024-01-07 15:00:00')")
        assert sorted(r.id for r in left.collect()) == sorted(r.id for r in want.collect())
        assert {d: files(d) for d in a.keep} == before


def test_plan_reads_no_whole_partition(spark, tmp):
    """Every file but the newest and the boundary day's is made unreadable: planning and the boundary still work."""
    root = os.path.join(tmp, "data")
    _dated(spark, root)
    for day in ["2024-01-01", "2024-01-05", "2024-01-08"]:
        folder = os.path.join(root, "dataset=a", f"date={day}")
        for f in os.listdir(folder):
            if f.endswith(".parquet"):
                open(os.path.join(folder, f), "wb").close()
            elif f.endswith(".crc"):
                os.remove(os.path.join(folder, f))
    a = retention.plan(spark, root, {"a": 3, "b": 1, "c": 1})[0]
    assert a.rewrite == ["2024-01-07"]
    retention.apply(spark, root, [a])
    assert "date=2024-01-05" not in os.listdir(os.path.join(root, "dataset=a")) and "date=2024-01-08" in os.listdir(os.path.join(root, "dataset=a"))


def test_interrupted_between_the_two_moves(spark, tmp):
    """The cutoff's day is away and its new rows aren't there yet: the next plan brings it back and carries on."""
    import shutil
    root = os.path.join(tmp, "data")
    df = _dated(spark, root).persist()
    os.makedirs(os.path.join(root, "_expired", "dataset=a"))
    shutil.move(os.path.join(root, "dataset=a", "date=2024-01-07"), os.path.join(root, "_expired", "dataset=a", "date=2024-01-07"))
    os.makedirs(os.path.join(root, "_retained", "dataset=a"))
    days = {"a": 3, "b": 1, "c": 1}
    retention.apply(spark, root, retention.plan(spark, root, days))
    want = df.where("dataset = 'b' OR (dataset = 'a' AND event_time >= timestamp'2024-01-07 15:00:00')")
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == sorted(r.id for r in want.collect())
    assert not [f for f in os.listdir(root) if f.startswith("_") and f != "_SUCCESS"]


def test_no_dataset(spark, tmp):
    assert retention.plan(spark, os.path.join(tmp, "none"), {}) == [] and retention.summary(spark, tmp, []).count() == 0


def test_places_lose_no_pair(spark):
    """All pairs of buses, by brute force, from the pairs of places and the membership; a depot of 400 buses is one row."""
    rnd = random.Random(4)
    spots = [(52.0 + rnd.randrange(12) * 0.0006, 13.0 + rnd.randrange(12) * 0.0009) for _ in range(40)]
    buses = [(f"d{i:03d}", 52.0, 13.0) for i in range(400)] + [(f"b{i:03d}", *rnd.choice(spots)) for i in range(120)]
    pos = spark.createDataFrame(buses, "bus_id string, lat double, lon double")
    every = {(r.bus_a, r.bus_b) for r in history.buses_within(pos).collect()}
    members = {}
    places = {r.bus_id: (r.place_id, r.n_within) for r in history.bus_places(pos).collect()}
    for bus, (place, _) in places.items():
        members.setdefault(place, []).append(bus)
    pairs = history.places_within(pos).collect()
    expanded = {tuple(sorted((x, y))) for r in pairs for x in members[r.place_a] for y in members[r.place_b]}
    expanded |= {(x, y) for m in members.values() for x in m for y in m if x < y}
    assert expanded == every and len(every) > 80_000 and len(pairs) < 800
    degree = dict.fromkeys(places, 0)
    for x, y in every:
        degree[x] += 1
        degree[y] += 1
    assert degree == {b: n for b, (_, n) in places.items()}


def test_sql_text_over_named_relations_in_a_stream(spark, tmp):
    air, zones = td.air_quality(spark, SF), td.zone_profile(spark, SF)
    src, out = os.path.join(tmp, "air"), os.path.join(tmp, "out")
    stage(air, [f.name for f in schemas.AIR_QUALITY.fields], "sensor_id", src, 3)
    stream = stream_of(spark, src, schemas.AIR_QUALITY).withWatermark("event_time", "5 minutes")
    collect_to(relations.advisories_by_sql(spark, stream, zones), out, f"sql_{os.path.basename(tmp)}", mode="update")
    emitted = spark.read.parquet(out)
    last = emitted.groupBy("zone", "window_start").agg(F.max_by(F.struct("rolling_avg_aqi", "readings"), "_batch").alias("v"))
    cols = ["zone", "window_start", "rolling_avg_aqi", "readings"]
    want = set(_rows(aggregates.health_advisories(air, zones), cols))
    assert want <= set(_rows(last.select("zone", "window_start", "v.*"), cols)) and len(want) == 1867
