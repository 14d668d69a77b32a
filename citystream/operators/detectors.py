"""Incident detectors (P4, W3, J3/W4/W5) and the unified incident feed.

Batch forms are relational; the streaming twins of the two stateful
detectors live in ``citystream.streaming.stateful``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.config import (AQI_EMERGENCY, AQI_HAZARDOUS, GRIDLOCK_CYCLES, GRIDLOCK_WAIT_SEC,
                               TRAFFIC_GRIDLOCK)
from citystream.operators import sequence

# Every detector's alerts carry all columns with these types, so that feeds
# written apart are read back as one table.
INCIDENT_SCHEMA = ("incident_type string, sensor_id string, junction_id string, route_id string, zone string, aqi double, "
                   "avg_wait_sec double, consecutive_cycles int, bus_a string, bus_b string, distance_m double, "
                   "minutes_close double, detected_from_timestamp string, event_time timestamp, event_id bigint")
INCIDENT_TYPES = dict(c.split() for c in INCIDENT_SCHEMA.split(", "))


def aqi_emergencies(air: DataFrame, threshold: float = AQI_HAZARDOUS) -> DataFrame:
    """Stateless; aqi present and strictly above the threshold. Values
    above the valid range still alert (no validator sits in front)."""
    return (air.where(F.col("aqi").isNotNull() & (F.col("aqi") > F.lit(float(threshold))))
            .select(F.lit(AQI_EMERGENCY).alias("incident_type"), "sensor_id", "zone", "aqi",
                    F.col("timestamp").alias("detected_from_timestamp"), "event_time", "event_id"))


def incident_feed(*alerts: DataFrame) -> DataFrame:
    """Bag union of heterogeneous alert schemas into one feed."""
    def typed(df: DataFrame) -> DataFrame:
        return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in INCIDENT_TYPES.items()))

    return reduce(DataFrame.unionByName, map(typed, alerts))


def gridlock_alerts(signals: DataFrame, wait_sec: float = GRIDLOCK_WAIT_SEC,
                    cycles: int = GRIDLOCK_CYCLES,
                    chunk_seconds: int = sequence.DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Per junction, an alert on every ``cycles``-th consecutive cycle with
    ``avg_wait_sec`` (missing -> 0) strictly above ``wait_sec``.

    Order is (event_time, event_id). The counter resets on any cycle at or
    below the threshold and after each alert, so alerts fall exactly on run
    positions divisible by ``cycles``. Runs are found chunk-split
    (:func:`sequence.streak_positions`), so a hot junction spreads over tasks.
    Records without a junction are grouped under 'UNKNOWN' (their alert keeps
    the null id).
    """
    wait = F.coalesce(F.col("avg_wait_sec"), F.lit(0.0))
    rows = signals.select(
        F.coalesce("junction_id", F.lit("UNKNOWN")).alias("_key"), "junction_id", "zone",
        wait.alias("_wait"), (wait > F.lit(float(wait_sec))).alias("_over"), "timestamp",
        "event_time", "event_id",
        sequence.time_chunk("event_time", chunk_seconds).alias("_chunk"))
    runs = sequence.streak_positions(rows, ["_key"], ["event_time", "event_id"], "_over")
    return (runs.where(F.col("run_pos") % cycles == 0)
            .select(F.lit(TRAFFIC_GRIDLOCK).alias("incident_type"), "junction_id", "zone",
                    F.col("_wait").alias("avg_wait_sec"),
                    F.lit(cycles).alias("consecutive_cycles"),
                    F.col("timestamp").alias("detected_from_timestamp"), "event_time", "event_id"))
