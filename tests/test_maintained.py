"""Maintained tables and the one-query incident feed: equal to the batch
results after restarts, replays and a crash between write and swap."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from test_streaming import SF, _rows, stage, stream_of

from citystream import schemas
from citystream.operators import aggregates, bunching, detectors, history, serving
from citystream.sources import testdata as td
from citystream.streaming import jobs, maintained


def _typed(df):
    return sorted(tuple(map(str, r)) for r in df.select(*[c for c in detectors.INCIDENT_TYPES if c != "event_time"], F.unix_micros("event_time")).collect())


def test_one_incident_query_with_a_restart(spark, tmp):
    kinds = (("air", td.air_quality, schemas.AIR_QUALITY, "sensor_id"), ("sig", td.traffic_signals, schemas.TRAFFIC_SIGNALS, "junction_id"),
             ("gps", td.bus_gps, schemas.BUS_GPS, "route_id"))
    rest = [stage(fn(spark, SF), [f.name for f in schema.fields], key, os.path.join(tmp, n), 4, write=[0, 1]) for n, fn, schema, key in kinds]
    out, latest, topic, ids = *(os.path.join(tmp, x) for x in ("incidents", "latest", "topic")), set()
    for more in ([], rest):
        for write in more:
            write()
        streams = [stream_of(spark, os.path.join(tmp, n), schema) for n, _, schema, _ in kinds]
        q = jobs.incident_query(*streams, out, name=f"one_{os.path.basename(tmp)}", bunching_sec=86_400, topic_fmt="json", topic_target=topic,
                                latest_root=latest).trigger(availableNow=True).start()
        q.awaitTermination()
        ids.add(str(q.id))
    batch = detectors.incident_feed(
        detectors.aqi_emergencies(td.air_quality(spark, SF)), detectors.gridlock_alerts(td.traffic_signals(spark, SF)),
        bunching.bunching_alerts(td.bus_gps(spark, SF), duration_sec=86_400))
    feed = spark.read.parquet(out).select(*detectors.INCIDENT_TYPES)
    assert len(ids) == 1 and _typed(feed) == _typed(batch)
    assert spark.read.json(topic).count() == feed.count() == 153
    kept = maintained.read_table(spark, latest, detectors.INCIDENT_SCHEMA)
    assert _typed(kept) == _typed(serving.latest(batch, serving.incident_order())) and kept.count() == 100


def test_latest_reads_the_table_and_the_batch_only(spark, tmp):
    """The merged rows are the top of all batches; a merge reads no more than n rows of what came before."""
    root = os.path.join(tmp, "top")
    order = [F.col("t").desc(), F.col("id")]
    for b in range(6):
        rows = spark.range(b * 1000, b * 1000 + 1000).select("id", (F.col("id") * 7919 % 5003).alias("t"))
        maintained.keep_latest(rows, root, order, f"q-{b}", n=10)
    table = maintained.Table(spark, root)
    every = spark.range(6000).select("id", (F.col("id") * 7919 % 5003).alias("t"))
    assert [tuple(r) for r in table.read("id long, t long").orderBy(*order).collect()] == [tuple(r) for r in every.orderBy(*order).limit(10).collect()]
    assert table.read("id long, t long").count() == 10 and table.version == 6
    # Replaced versions go: as many data folders as manifests, three of each.
    assert len(os.listdir(os.path.join(root, "data"))) == maintained.KEPT_VERSIONS


def test_crash_between_write_and_swap(spark, tmp, monkeypatch):
    root, order = os.path.join(tmp, "top"), [F.col("id").desc()]
    maintained.keep_latest(spark.range(10), root, order, "q-0", n=3)
    with monkeypatch.context() as m:
        m.setattr(maintained.Table, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
        with pytest.raises(RuntimeError):
            maintained.keep_latest(spark.range(10, 20), root, order, "q-1", n=3)
    ids = lambda: sorted(r.id for r in maintained.read_table(spark, root, "id long").collect())
    assert ids() == [7, 8, 9]
    for _ in range(2):  # the replay, and one whose commit to the checkpoint was lost
        maintained.keep_latest(spark.range(10, 20), root, order, "q-1", n=3)
        assert ids() == [17, 18, 19] and maintained.Table(spark, root).version == 2


def test_second_writer_fails(spark, tmp):
    root = os.path.join(tmp, "top")
    maintained.keep_latest(spark.range(3), root, [F.col("id")], "q-0")
    mine, other = maintained.Table(spark, root), maintained.Table(spark, root)
    other.commit({}, "p-0")
    with pytest.raises(RuntimeError):
        mine.commit({}, "q-1")


def test_upsert_rewrites_touched_dates_only(spark, tmp):
    root = os.path.join(tmp, "adv")
    schema = "zone string, day date, v int"
    make = lambda rows: spark.createDataFrame(rows, "zone string, day string, v int").withColumn("day", F.to_date("day"))
    maintained.upsert(make([("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("a", "2024-01-02", 3), (None, None, 4)]), root, ["zone", "day"], "day", "q-0")
    before = maintained.Table(spark, root).parts
    change = make([("b", "2024-01-01", 20), ("c", "2024-01-01", 30), (None, None, 40)])
    for _ in range(2):
        maintained.upsert(change, root, ["zone", "day"], "day", "q-1")
        table = maintained.Table(spark, root)
        assert sorted((str(r.zone), str(r.day), r.v) for r in table.read(schema).collect()) == [
            ("None", "None", 40), ("a", "2024-01-01", 1), ("a", "2024-01-02", 3), ("b", "2024-01-01", 20), ("c", "2024-01-01", 30)]
        assert table.parts["2024-01-02"] == before["2024-01-02"] and table.parts["2024-01-01"] != before["2024-01-01"] and table.version == 2
    maintained.upsert(make([]), root, ["zone", "day"], "day", "q-2")
    assert maintained.Table(spark, root).version == 2


def test_advisories_upserted_equal_batch(spark, tmp):
    air, zones = td.air_quality(spark, SF), td.zone_profile(spark, SF)
    src, root = os.path.join(tmp, "air"), os.path.join(tmp, "table")
    rest = stage(air, [f.name for f in schemas.AIR_QUALITY.fields], "sensor_id", src, 4, write=[0, 1])
    for more in (lambda: None, rest):
        more()
        rows = jobs.advisory_query(stream_of(spark, src, schemas.AIR_QUALITY), zones).withColumn("day", F.to_date("window_start"))
        jobs.upsert_query(rows, ["zone", "window_start"], root, "day", f"upsert_{os.path.basename(tmp)}").trigger(availableNow=True).start().awaitTermination()
    got = maintained.read_table(spark, root, rows.schema)
    cols = ["zone", "window_start", "rolling_avg_aqi", "readings"]
    want = aggregates.health_advisories(air, zones)
    assert got.count() == got.select("zone", "window_start").distinct().count()
    # A window that fell back is left as it last stood: update mode sends no retraction.
    assert set(_rows(want, cols)) <= set(_rows(got, cols)) and want.count() == 1867


def test_rollup_adds_batches_and_reads_their_periods(spark, tmp):
    summary = aggregates.ward_energy(td.smart_meters(spark, SF)).persist()
    root, days = os.path.join(tmp, "weeks"), sorted(r[0] for r in summary.select(F.to_date("window_start")).distinct().collect())
    cuts = [days[0], days[len(days) // 3], days[2 * len(days) // 3], None]
    folders = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        day = F.to_date("window_start")
        part = summary.where((day >= F.lit(lo)) & (F.lit(True) if hi is None else day < F.lit(hi)))
        for _ in range(2):
            maintained.add_rollup(part, root, "week", f"q-{i}")
        folders.append(maintained.Table(spark, root).parts)
    assert any(folders[0][p] == folders[2][p] for p in folders[0])  # whole weeks of the first batch are left alone
    states = history.rollup_states(summary, "week")
    got = history.rollup_of(maintained.read_table(spark, root, states.schema))
    want = history.ward_rollup(summary, "week")
    key = lambda df: sorted(map(str, df.collect()))
    assert got.dtypes == want.dtypes and key(got) == key(want)
