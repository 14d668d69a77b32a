"""Sources, sinks and helpers that need no streaming run."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from citystream import schemas
from citystream.functions.numeric import round_ratio
from citystream.operators import history
from citystream.operators.joins import broadcast_if_small
from citystream.streaming import sinks, sources


def test_kafka_options():
    o = sources.kafka_options(["h1:9092", "h2:9092"], ["air_quality", "bus_gps"], "earliest", 1000)
    assert o["kafka.bootstrap.servers"] == "h1:9092,h2:9092"
    assert o["subscribe"] == "air_quality,bus_gps" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "1000"
    b = sources.bounded_kafka_options("h:1", "dlq", 1000, 2000)
    assert "startingOffsets" not in b and b["startingTimestamp"] == "1000" and b["endingTimestamp"] == "2000"
    k = sinks.kafka_sink_options("h:1", "incidents")
    assert k["kafka.acks"] == "all" and k["kafka.retries"] == "3" and k["topic"] == "incidents"


def test_decode_malformed_and_bad_timestamp(spark):
    env = spark.createDataFrame(
        [("k", '{"sensor_id": "s", "zone": "Z1", "aqi": 150.5, "timestamp": "2024-01-01T00:00:00Z"}',
          "air_quality", 1, 5),
         ("k", "{broken", "air_quality", 0, 6),
         ("k", '{"sensor_id": "s", "aqi": 10, "timestamp": "garbage"}', "air_quality", 0, 7)],
        "key string, value string, topic string, partition int, offset long")
    rows = {r.offset: r for r in sources.decode(env, schemas.AIR_QUALITY, keep_corrupt=True).collect()}
    assert rows[5].aqi == 150.5 and rows[5].event_time is not None and rows[5]._corrupt_record is None
    assert rows[5].event_id == 5 * 2 + 1
    assert rows[6]._corrupt_record == "{broken"
    assert rows[7].event_time is None  # ANSI-safe parse


def test_lookup_csv_explicit_schema(spark, tmp):
    p = os.path.join(tmp, "routes.csv")
    with open(p, "w") as f:
        f.write("route_id,route_name,scheduled_arrival_time,terminal\nR1,A - B,08:15,T1\n")
    r = sources.read_lookup_csv(spark, p, "route_schedule").first()
    assert r.scheduled_arrival_time == "08:15"


def test_topic_records_and_keyed_layout(spark):
    df = spark.createDataFrame([("R1", None, 1.5)], "route_id string, name string, x double")
    rec = sinks.as_topic_records(df, key="route_id", keep_nulls=True).first()
    assert rec.key == "R1" and rec.value == '{"route_id":"R1","name":null,"x":1.5}'
    plan = sinks.keyed_layout(df, "route_id", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(route_id" in plan


def test_report_file(spark, tmp):
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "line_no int, line string")
    out = os.path.join(tmp, "report")
    sinks.write_report(lines, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert text == "a\nb\n"


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in broadcast_if_small(small, 100)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_small(big, 100) is big


def test_round_ratio_matches_binary_rounding(spark):
    nums = [55_149_000, 20_679_000, 20_679_001, 303_000, 330_000, 3_000, 9_000, 123_456_789,
            915_000, 909_000, 45_000, 15_000]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in nums], "n long")
           .select(round_ratio(F.col("n"), 60000, 1)).collect()]
    assert got == [round(n / 60000, 1) for n in nums]


def test_history_write_read_rollup(spark, tmp):
    import datetime as dt
    rows = [("W1", dt.datetime(2024, 1, d, h), 1.0, 0.9, 230.0) for d in (1, 2, 8) for h in (0, 1)]
    df = spark.createDataFrame(rows, "ward_id string, window_start timestamp, total_kwh_consumed double, "
                                     "avg_power_factor double, peak_voltage double")
    from citystream.operators.aggregates import with_partition_date
    path = os.path.join(tmp, "hist")
    history.write_history(with_partition_date(df), path)
    back = history.read_history(spark, path, wards=["W1"], date_from="2024-01-02")
    assert back.count() == 4
    weekly = {r.period_start.day: float(r.total_kwh_consumed) for r in history.ward_rollup(back, "week").collect()}
    assert weekly == {1: 2.0, 8: 2.0}


def test_bounded_dlq_report_file(spark, tmp):
    import datetime as dt
    from citystream.operators import quality
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    dlq = spark.createDataFrame(
        [("NULL_AQI", "air_quality", t0 - dt.timedelta(seconds=s)) for s in (10, 100, 299)]
        + [("NULL_GPS", "bus_gps", t0 - dt.timedelta(seconds=301)),
           ("IMPOSSIBLE_GPS", "bus_gps", t0 - dt.timedelta(seconds=50))],
        "error_reason string, source_topic string, quarantined_at timestamp")
    recent = quality.within_last(dlq, 300, as_of=F.lit(t0).cast("timestamp"))
    out = os.path.join(tmp, "dlq_report")
    sinks.write_report(quality.report_lines(quality.report_counts(recent), 300), out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert "Total bad records: 4" in text
    assert "   NULL_AQI                3  ( 75.0%)" in text
    assert "   IMPOSSIBLE_GPS          1  ( 25.0%)" in text
    assert "   air_quality                       3" in text and "NULL_GPS" not in text
