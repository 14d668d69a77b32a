"""Small builders for hand-made city-stream rows in tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00"


def frame(spark, rows, schema: str):
    """rows of dicts -> DataFrame; adds timestamp text, event_time, event_id,
    topic/partition/offset when missing."""
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("event_id", i)
        t = r.pop("t", None)
        r.setdefault("event_time", ts(t) if t is not None else None)
        r.setdefault("timestamp", iso(r["event_time"]) if r["event_time"] is not None else None)
        r.setdefault("topic", "t")
        r.setdefault("partition", 0)
        r.setdefault("offset", r["event_id"])
        out.append(r)
    full = schema + ", timestamp string, event_time timestamp, event_id long, topic string, partition int, offset long"
    df = spark.createDataFrame(out, full)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))
