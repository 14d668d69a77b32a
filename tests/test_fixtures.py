"""Hand-computed edge cases per operator (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from citystream.functions.timefn import millis_to_days
from citystream.operators import aggregates, bunching, detectors, enrich, quality, serving
from helpers import frame, ts

AQ = "sensor_id string, zone string, aqi double"
GPS = "bus_id string, route_id string, lat double, lon double"
SIG = "junction_id string, zone string, avg_wait_sec double"

# One degree of latitude in metres on the 6,371 km sphere; used to place buses.
M_PER_DEG = 6_371_000 * 3.141592653589793 / 180


def test_p4_aqi_emergency(spark):
    rows = [{"sensor_id": "s", "zone": "Z1", "aqi": a, "t": i} for i, a in enumerate([300.0, 301.0, 600.0, None])]
    out = detectors.aqi_emergencies(frame(spark, rows, AQ)).collect()
    assert sorted(r.aqi for r in out) == [301.0, 600.0]
    assert {r.incident_type for r in out} == {"AQI_EMERGENCY"}


def test_p6_air_rules(spark):
    rows = [{"sensor_id": "s", "zone": "Z1", "aqi": a, "t": i} for i, a in enumerate([None, -1.0, 0.0, 500.0, 501.0])]
    got = [r.error_reason for r in quality.validate(frame(spark, rows, AQ), "air_quality").orderBy("event_id").collect()]
    assert got == ["NULL_AQI", "AQI_OUT_OF_RANGE", None, None, "AQI_OUT_OF_RANGE"]


def test_p6_gps_rules_and_other_topics(spark):
    pts = [(None, 1.0), (90.0, 180.0), (90.1, 0.0), (0.0, -181.0), (None, 999.0)]
    rows = [{"bus_id": "b", "route_id": "R", "lat": a, "lon": o, "t": i} for i, (a, o) in enumerate(pts)]
    df = frame(spark, rows, GPS)
    got = [r.error_reason for r in quality.validate(df, "bus_gps").orderBy("event_id").collect()]
    assert got == ["NULL_GPS", None, "IMPOSSIBLE_GPS", "IMPOSSIBLE_GPS", "NULL_GPS"]
    assert quality.validate(df, "traffic_signals").where("error_reason is not null").count() == 0


def test_dlq_envelope_and_malformed(spark):
    rows = [{"sensor_id": "s", "zone": "Z1", "aqi": None, "t": 0}]
    df = frame(spark, rows, AQ)
    out = quality.dlq_records({"air_quality": df}, {"air_quality": ["sensor_id", "zone", "aqi"]}).collect()
    assert out[0].error_reason == "NULL_AQI" and out[0].source_topic == "air_quality"
    assert '"aqi":null' in out[0].original and out[0].quarantined_at is not None
    bad = df.withColumn("_corrupt_record", F.lit("{not json"))
    assert quality.validate(bad, "air_quality").first().error_reason == "MALFORMED_JSON"


def test_s7_last_duplicate_wins_and_j1_defaults(spark):
    sched = spark.createDataFrame(
        [("R1", "old", "08:00", "T-old", 0), ("R2", "two", "08:10", "T2", 1), ("R1", "new", "08:05", "T-new", 2)],
        "route_id string, route_name string, scheduled_arrival_time string, terminal string, seq long")
    table = {r.route_id: r for r in enrich.route_table(sched).collect()}
    assert table["R1"].route_name == "new" and table["R1"].scheduled_arrival_time == "08:05"
    gps = frame(spark, [{"bus_id": "a", "route_id": r, "lat": 1.0, "lon": 1.0, "t": i}
                        for i, r in enumerate(["R1", "R9", None])], GPS)
    out = {r.event_id: r for r in enrich.enrich_bus_gps(gps, enrich.route_table(sched)).collect()}
    assert out[0].route_name == "new" and out[0].terminal == "T-new"
    for i in (1, 2):
        assert (out[i].route_name, out[i].scheduled_arrival_time, out[i].terminal) == ("UNKNOWN", None, "UNKNOWN")


def test_a1_tumbling_windows(spark):
    rows = [{"meter_id": "m", "ward_id": "W1", "kwh_reading": 1.0, "voltage": v, "power_factor": 0.9, "t": t}
            for t, v in [(0, 220.0), (899, 230.0), (900, 225.0)]]
    df = frame(spark, rows, "meter_id string, ward_id string, kwh_reading double, voltage double, power_factor double")
    out = aggregates.ward_energy(df).orderBy("window_start").collect()
    assert [(r.total_kwh_consumed, r.peak_voltage) for r in out] == [(2.0, 230.0), (1.0, 225.0)]
    assert out[0].window_start == ts(0) and out[0].window_end == ts(900)


def test_a2_sliding_windows_batch_and_native_agree(spark):
    rows = [{"sensor_id": "s", "zone": "Z1", "aqi": 200.0, "t": 330}]  # 00:05:30
    df = frame(spark, rows, AQ)
    starts = sorted(r.window_start for r in aggregates.rolling_aqi(df).collect())
    assert len(starts) == 10
    assert starts[0] == ts(330) - dt.timedelta(minutes=9, seconds=30) and starts[-1] == ts(300)
    # A fractional reading is null under the INT schema of the job and drops.
    frac = frame(spark, [{"sensor_id": "s", "zone": "Z1", "aqi": 150.5, "t": 0}], AQ)
    assert aggregates.rolling_aqi(frac).count() == 0


def test_p12_threshold_strict_and_j2_inner(spark):
    zones = spark.createDataFrame([("Z1", "One", 10, 1)], "zone string, zone_name string, population int, num_schools int")
    # Window average exactly 150 (dropped) vs 150.04 (kept, shown 150.0); Z2 has no profile.
    rows = ([{"sensor_id": "a", "zone": "Z1", "aqi": 150.0, "t": 0}]
            + [{"sensor_id": "b", "zone": "Z1", "aqi": a, "t": 3600 + i} for i, a in enumerate([150.0] * 24 + [151.0])]
            + [{"sensor_id": "c", "zone": "Z2", "aqi": 400.0, "t": 0}])
    out = aggregates.health_advisories(frame(spark, rows, AQ), zones).collect()
    assert out and all(r.zone == "Z1" for r in out)
    assert {r.rolling_avg_aqi for r in out} == {150.0}  # 150.04 rounded; plain 150 windows absent
    assert all(r.window_start >= ts(3000) for r in out)


def _gridlock(spark, waits):
    rows = [{"junction_id": "J", "zone": "Z", "avg_wait_sec": w, "t": i} for i, w in enumerate(waits)]
    return sorted(r.event_id for r in detectors.gridlock_alerts(frame(spark, rows, SIG)).collect())


def test_w3_gridlock(spark):
    assert _gridlock(spark, [200.0] * 7) == [2, 5]
    assert _gridlock(spark, [200.0, 200.0, 180.0, 200.0, 200.0, 200.0]) == [5]
    assert _gridlock(spark, [200.0, 200.0, None, 200.0]) == []


def _bus_rows(sep_m, far_at=None, far_m=250.0, step=60, n=13):
    # Bus B reports once, before the run; bus A reports every minute, so the
    # pair is observed exactly once per minute from t=0.
    rows = [{"bus_id": "B", "route_id": "R", "lat": 12.0, "lon": 77.0, "t": -1}]
    for k in range(n):
        t = k * step
        sep = far_m if far_at is not None and t == far_at else sep_m
        rows.append({"bus_id": "A", "route_id": "R", "lat": 12.0 + sep / M_PER_DEG, "lon": 77.0, "t": t})
    return rows


def _alerts(spark, rows, **kw):
    df = frame(spark, rows, GPS)
    return sorted((round((r.event_time - ts(0)).total_seconds()), r.minutes_close)
                  for r in bunching.bunching_alerts(df, **kw).collect())


def test_w5_bunching_restart_and_clear(spark):
    # 55 m apart: first close at 0 s; alert at 360 s (300 is not > 300),
    # restart, next at 720 s.
    got = _alerts(spark, _bus_rows(55.0))
    assert got == [(360, 6.0), (720, 6.0)]
    # 250 m apart at 240 s clears the timer; restart at 300 s; alert at 660 s.
    assert _alerts(spark, _bus_rows(55.0, far_at=240)) == [(660, 6.0)]


def test_w5_edge_and_routes(spark):
    from citystream.functions.geo import haversine_m
    rows = [{"bus_id": "A", "route_id": "R", "lat": 0.0, "lon": 0.0, "t": 0},
            {"bus_id": "B", "route_id": "R", "lat": 200.0 / M_PER_DEG, "lon": 0.0, "t": 1},
            {"bus_id": "A", "route_id": "R", "lat": 0.0, "lon": 0.0, "t": 400}]
    d = spark.range(1).select(haversine_m(F.lit(0.0), F.lit(0.0), F.lit(200.0 / M_PER_DEG), F.lit(0.0))).first()[0]
    assert abs(d - 200.0) < 1e-6
    assert len(_alerts(spark, rows, distance_m=d)) == 1  # distance equal to the limit is close
    other = [dict(r, route_id="R2") if r["bus_id"] == "B" else r for r in rows]
    assert _alerts(spark, other, distance_m=d) == []


def test_a3_a4_distribution(spark):
    dlq = spark.createDataFrame([("NULL_AQI", "air_quality")] * 3 + [("NULL_GPS", "bus_gps")],
                                "error_reason string, source_topic string")
    counts = quality.report_counts(dlq)
    dist = {r.error_reason: (r.n, r.pct) for r in quality.error_distribution(counts).collect()}
    assert dist == {"NULL_AQI": (3, 75.0), "NULL_GPS": (1, 25.0)}
    empty = quality.report_counts(dlq.limit(0))
    assert quality.error_distribution(empty).count() == 0
    lines = [r.line for r in quality.report_lines(empty, 300).orderBy("line_no").collect()]
    assert "Total bad records: 0" in lines


def test_a6_consumer_lag(spark):
    committed = spark.createDataFrame([("g", "t", 0, 4), ("g", "t", 1, 7)],
                                      "group_id string, topic string, partition int, committed_offset long")
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 5)], "topic string, partition int, end_offset long")
    groups = spark.createDataFrame([("g",), ("idle",)], "group_id string")
    got = {r.group_id: r.lag for r in serving.consumer_lag(committed, ends, groups).collect()}
    assert got == {"g": 6, "idle": None}


def test_o2_latest_and_p13_view(spark):
    df = spark.range(150).withColumn("event_time", F.col("id").cast("timestamp"))
    top = serving.latest(df, [F.col("event_time").desc()]).collect()
    assert len(top) == 100 and top[0].id == 149 and top[-1].id == 50
    env = spark.createDataFrame([("t", 0, 1, '{"a": 1}'), ("t", 0, 2, "hello")],
                                "topic string, partition int, offset long, value string")
    lines = [r.line for r in serving.topic_view(env).orderBy("offset").collect()]
    assert lines == ['[p0@1] {"a": 1}', "[p0@2] hello"]


def test_f13_retention_days(spark):
    df = spark.createDataFrame([(86_400_000,), (604_800_000,), (86_399_999,), (-1,), (None,)], "ms long")
    assert [r[0] for r in df.select(millis_to_days(df.ms)).collect()] == [1, 7, 0, None, None]
