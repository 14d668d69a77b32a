"""Serving views and consumer-side operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from citystream.config import AQI_HAZARDOUS, AQI_UNHEALTHY, GRIDLOCK_WAIT_SEC, SERVING_LATEST_N
from citystream.functions.jsonfn import pretty_or_raw


def latest(df: DataFrame, order: list[Column], n: int = SERVING_LATEST_N) -> DataFrame:
    """O2: the newest ``n`` records, newest first. ``order`` must be a total
    order. Spark plans this as a per-partition top-n merged on the driver
    side of the exchange (TakeOrderedAndProject): memory bounded by ``n``."""
    return df.orderBy(*order).limit(n)


def incident_order() -> list[Column]:
    return [F.col("event_time").desc_nulls_last(), F.col("event_id").desc(),
            F.col("incident_type").asc(), F.coalesce("bus_a", F.lit("")).asc(),
            F.coalesce("bus_b", F.lit("")).asc()]


def numeric_columns(df: DataFrame) -> DataFrame:
    """Keep only numeric columns (what a chart can plot)."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])


def topic_view(envelope: DataFrame) -> DataFrame:
    """``[p<partition>@<offset>] <json or raw text>`` per record."""
    return envelope.select("topic", "partition", "offset", F.concat(
        F.lit("[p"), F.col("partition").cast("string"), F.lit("@"), F.col("offset").cast("string"),
        F.lit("] "), pretty_or_raw(F.col("value"))).alias("line"))


def signal_adaptations(signals: DataFrame, wait_sec: float = GRIDLOCK_WAIT_SEC) -> DataFrame:
    """P5: HIGH-priority reaction — every reading whose wait (missing -> 0)
    exceeds the threshold, with its partition and offset."""
    wait = F.coalesce(F.col("avg_wait_sec"), F.lit(0.0))
    return signals.where(wait > F.lit(float(wait_sec))).select(
        "junction_id", wait.alias("avg_wait_sec"), "partition", "offset")


def partition_throughput(envelope: DataFrame) -> DataFrame:
    """Messages per topic partition."""
    return envelope.groupBy("topic", "partition").agg(F.count("*").alias("messages"))


def end_offsets(envelope: DataFrame) -> DataFrame:
    """Log-end offset per (topic, partition): last offset + 1."""
    return envelope.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def consumer_lag(committed: DataFrame, ends: DataFrame, groups: DataFrame) -> DataFrame:
    """A6 + J4: per group, sum over its committed partitions of
    max(0, end - committed); a partition without an end offset counts as 0;
    a group without commits has a null lag.

    ``committed``: group_id, topic, partition, committed_offset;
    ``ends``: topic, partition, end_offset; ``groups``: group_id.
    """
    per_part = (committed.join(ends, ["topic", "partition"], "left")
                .select("group_id", F.greatest(F.lit(0), F.coalesce("end_offset", F.lit(0))
                                               - F.col("committed_offset")).alias("lag")))
    lag = per_part.groupBy("group_id").agg(F.sum("lag").alias("lag"))
    return groups.select("group_id").join(lag, "group_id", "left")


def zone_status(rolling: DataFrame, hazardous: float = AQI_HAZARDOUS,
                unhealthy: float = AQI_UNHEALTHY) -> DataFrame:
    """Plain-language status per zone from its latest rolling window."""
    last = rolling.groupBy("zone").agg(
        F.max_by(F.struct("window_start", "window_end", "rolling_avg_aqi"), F.col("window_start")).alias("w"))
    avg = F.col("w.rolling_avg_aqi")
    status = F.when(avg > F.lit(float(hazardous)), "Hazardous") \
              .when(avg > F.lit(float(unhealthy)), "Unhealthy").otherwise("Acceptable")
    return last.select("zone", F.col("w.window_start").alias("window_start"),
                       F.round(avg, 1).alias("rolling_avg_aqi"), status.alias("status"),
                       F.concat(F.lit("AQI: "), status, F.lit(" in Zone "), F.col("zone")).alias("message"))
