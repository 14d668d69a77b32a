"""City streams derived from the driver's TESTDATA tables.

``events`` becomes the four sensor streams, ``nation``/``region`` the two lookup
tables. Each stream carries its source fields, ``event_time`` (TIMESTAMP),
``event_id`` (the total-order tie-break) and the Kafka-like ``topic``,
``partition``, ``offset`` columns. Fractional literals are typed DOUBLE so no
DECIMAL arithmetic sneaks in. The DuckDB twin of every projection lives in
``citystream.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.config import STREAM_PARTITIONS
from citystream.functions.timefn import ISO_UTC_PATTERN
from citystream.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, "events")


def _common(stream: str) -> list:
    n = STREAM_PARTITIONS[stream]
    return [
        F.date_format("ts", ISO_UTC_PATTERN).alias("timestamp"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id"),
        F.lit(stream).alias("topic"),
        (F.col("event_id") % n).cast("int").alias("partition"),
        F.expr(f"event_id div {n}").alias("offset"),
    ]


K = "cast(get_json_object(props, '$.k') as int)"
ZONE = "concat('Z', cast(1 + user_id % 6 as string))"


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.expr("concat('AQ-', cast(user_id as string))").alias("sensor_id"),
        F.expr(ZONE).alias("zone"),
        F.expr("value / 2.0D").alias("pm25"),
        F.col("value").alias("pm10"),
        F.expr(f"cast({K} as double)").alias("no2"),
        F.expr("CASE WHEN event_id % 20 = 0 THEN NULL "
               "ELSE cast(floor(value * 2.0D) as double) END").alias("aqi"),
        *_common("air_quality"))


def bus_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.expr("concat('B', cast(user_id as string))").alias("bus_id"),
        F.expr("concat('R', cast(101 + user_id div 3 as string))").alias("route_id"),
        F.expr("CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 102.97D "
               f"ELSE 12.9716D + ({K} % 10) * 0.0004D END").alias("lat"),
        F.lit(77.5946).alias("lon"),
        F.expr(f"cast({K} % 56 as double)").alias("speed_kmh"),
        F.expr(f"10 + {K} % 91").alias("occupancy_pct"),
        *_common("bus_gps"))


def traffic_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.expr("concat('J', cast(user_id % 12 as string))").alias("junction_id"),
        F.expr(ZONE).alias("zone"),
        F.expr(K).alias("vehicle_count"),
        F.expr("CASE WHEN event_id % 33 = 0 THEN NULL ELSE value * 4.0D END").alias("avg_wait_sec"),
        F.expr(f"CASE {K} % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN' ELSE 'AMBER' END")
        .alias("signal_phase"),
        *_common("traffic_signals"))


def smart_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.expr("concat('M', cast(user_id as string))").alias("meter_id"),
        F.expr("concat('W', cast(1 + user_id % 8 as string))").alias("ward_id"),
        F.col("value").alias("kwh_reading"),
        F.expr(f"218.0D + {K} * 0.27D").alias("voltage"),
        F.expr(f"0.8D + ({K} % 20) * 0.01D").alias("power_factor"),
        *_common("smart_meters"))


def route_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route lookup from ``nation`` (25 rows) with the region name as terminal.

    ``seq`` is the file order used for the last-duplicate-wins rule.
    """
    prepare(spark)
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.expr("concat('R', cast(101 + n_nationkey as string))").alias("route_id"),
                    F.col("n_name").alias("route_name"),
                    F.expr("concat('08:', lpad(cast(n_nationkey + 5 as string), 2, '0'))")
                    .alias("scheduled_arrival_time"),
                    F.col("r_name").alias("terminal"),
                    F.col("n_nationkey").cast("long").alias("seq")))


def zone_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup from ``region`` (5 rows, so zone Z6 has no profile)."""
    prepare(spark)
    return table(spark, sf_dir, "region").select(
        F.expr("concat('Z', cast(1 + r_regionkey as string))").alias("zone"),
        F.col("r_name").alias("zone_name"),
        F.expr("100000 + 10000 * r_regionkey").cast("int").alias("population"),
        F.expr("20 + r_regionkey").cast("int").alias("num_schools"))


STREAMS = {
    "air_quality": air_quality,
    "bus_gps": bus_gps,
    "traffic_signals": traffic_signals,
    "smart_meters": smart_meters,
}
