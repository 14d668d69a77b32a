"""Event-time window aggregates: ward energy (A1/W1), rolling AQI (A2/W2),
health advisories (J2/P12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.config import (ADVISORY_LEVEL, ADVISORY_SLIDE, ADVISORY_WINDOW, AQI_UNHEALTHY,
                               WARD_WINDOW)
from citystream.operators.joins import broadcast_if_small


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def ward_energy(meters: DataFrame, window: str = WARD_WINDOW) -> DataFrame:
    """Per (tumbling window, ward): kWh sum, mean power factor, peak voltage.

    All three aggregates are algebraic, so Spark combines map-side before the
    shuffle on (window, ward_id): a hot ward costs one partial row per task
    and window, never a task holding the ward's raw rows. Rows without an
    event time never enter a window.
    """
    agg = (meters.where(F.col("event_time").isNotNull())
           .groupBy(F.window("event_time", window).alias("w"), "ward_id")
           .agg(F.sum("kwh_reading").alias("total_kwh_consumed"),
                F.avg("power_factor").alias("avg_power_factor"),
                F.max("voltage").alias("peak_voltage")))
    return agg.select("ward_id",
                      F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"),
                      "total_kwh_consumed", "avg_power_factor", "peak_voltage")


def with_partition_date(df: DataFrame, col: str = "window_start") -> DataFrame:
    """P10: history partition date = UTC date of the window start."""
    return df.withColumn("date", F.to_date(col))


def _aqi_as_int(aqi):
    # The advisory job reads aqi with an INT schema: a fractional reading is
    # null there and drops out with the null filter.
    return F.when(aqi == F.floor(aqi), aqi.cast("long"))


def rolling_aqi(air: DataFrame, window: str = ADVISORY_WINDOW,
                slide: str = ADVISORY_SLIDE) -> DataFrame:
    """A2: per (zone, sliding window) mean AQI and reading count.

    Batch plan: aggregate raw rows once per (zone, slide bucket) — sum and
    count are exact and decomposable — then fan each bucket out to the
    window/slide windows covering it and add up. Raw rows are touched once
    instead of window/slide times, and the fan-out runs on the small
    bucket table. Streaming inputs use Spark's native sliding window because
    update-mode queries allow one stateful aggregation.
    """
    w_s, s_s = _seconds(window), _seconds(slide)
    base = (air.select("zone", _aqi_as_int(F.col("aqi")).alias("aqi_i"), "event_time")
            .where(F.col("aqi_i").isNotNull() & F.col("event_time").isNotNull()))
    if air.isStreaming or w_s % s_s:
        agg = (base.groupBy("zone", F.window("event_time", window, slide).alias("w"))
               .agg(F.avg("aqi_i").alias("rolling_avg_aqi"), F.count("*").alias("readings")))
        return agg.select("zone", F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), "rolling_avg_aqi", "readings")
    buckets = (base.groupBy("zone", F.window("event_time", slide).start.alias("b"))
               .agg(F.sum("aqi_i").alias("s"), F.count("*").alias("n")))
    fanned = (buckets.select("zone", "s", "n", "b",
                             F.explode(F.sequence(F.lit(0), F.lit(w_s // s_s - 1))).alias("k"))
              .select("zone", "s", "n",
                      (F.col("b") - F.make_dt_interval(secs=F.col("k") * F.lit(s_s)))
                      .alias("window_start")))
    agg = fanned.groupBy("zone", "window_start").agg(F.sum("s").alias("s"), F.sum("n").alias("readings"))
    return agg.select("zone", "window_start",
                      (F.col("window_start") + F.make_dt_interval(secs=F.lit(w_s))).alias("window_end"),
                      (F.col("s") / F.col("readings")).alias("rolling_avg_aqi"), "readings")


def health_advisories(air: DataFrame, zones: DataFrame, threshold: float = AQI_UNHEALTHY,
                      window: str = ADVISORY_WINDOW, slide: str = ADVISORY_SLIDE) -> DataFrame:
    """A2 + J2 + P12: windows whose unrounded mean AQI is strictly above the
    threshold, joined (inner) to the zone profile; unknown zones drop.

    The profile is broadcast after its size is checked; the filter on the
    aggregate stays above the aggregation (it cannot move below it).
    """
    rolling = rolling_aqi(air, window, slide).where(F.col("rolling_avg_aqi") > F.lit(float(threshold)))
    z = broadcast_if_small(zones.select("zone", "zone_name", "population", "num_schools"))
    return (rolling.join(z, "zone", "inner")
            .select("zone", "zone_name", "population", "num_schools", "window_start", "window_end",
                    F.round("rolling_avg_aqi", 1).alias("rolling_avg_aqi"), "readings",
                    F.lit(ADVISORY_LEVEL).alias("advisory_level")))
