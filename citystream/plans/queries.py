"""Registered queries: (spark, sf_dir) -> DataFrame over the TESTDATA tables.

Each query composes library operators on the adapted city streams and
normalises the output for comparison with its oracle: window bounds as
TIMESTAMP_NTZ (zone-free), double aggregates rounded to 4 places.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.config import CONSUMER_GROUPS, DLQ_REPORT_WINDOW_SEC, RETENTION_DAYS
from citystream.functions.jsonfn import payload_json
from citystream.functions.timefn import parse_event_time, to_ntz
from citystream.operators import aggregates, bunching, detectors, enrich, history, quality, relations, retention, serving
from citystream.session import scratch_path
from citystream.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]


def _ward_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.with_partition_date(aggregates.ward_energy(td.smart_meters(spark, sf_dir)))


def _ward_history(spark: SparkSession, sf_dir: str) -> str:
    """K4: the summaries as a Parquet history in the shared folder; its path."""
    path = scratch_path(spark, "ward_history")
    history.write_history(_ward_summary(spark, sf_dir), path)
    return path


def ward_energy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history, written by ward and date and read back."""
    return _ward_out(history.read_history(spark, _ward_history(spark, sf_dir)))


def ward_energy_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute ward energy summary with its partition date."""
    return _ward_out(_ward_summary(spark, sf_dir))


def _ward_out(out: DataFrame) -> DataFrame:
    return out.select("ward_id", to_ntz("window_start").alias("window_start"),
                      to_ntz("window_end").alias("window_end"),
                      F.round("total_kwh_consumed", 4).alias("total_kwh_consumed"),
                      F.round("avg_power_factor", 4).alias("avg_power_factor"),
                      F.round("peak_voltage", 4).alias("peak_voltage"),
                      F.col("date").cast("string").alias("date"))


def aqi_rolling_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 10-minute window (1-minute slide) per zone, unfiltered."""
    out = aggregates.rolling_aqi(td.air_quality(spark, sf_dir))
    return out.select("zone", to_ntz("window_start").alias("window_start"),
                      to_ntz("window_end").alias("window_end"),
                      F.round("rolling_avg_aqi", 4).alias("rolling_avg_aqi"), "readings")


def health_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2+J2+P12+P11: unhealthy rolling windows joined to the zone profile."""
    out = aggregates.health_advisories(td.air_quality(spark, sf_dir), td.zone_profile(spark, sf_dir))
    return out.withColumn("window_start", to_ntz("window_start")) \
              .withColumn("window_end", to_ntz("window_end"))


def _validated_streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"air_quality": td.air_quality(spark, sf_dir), "bus_gps": td.bus_gps(spark, sf_dir)}


RECORD_COLS = {
    "air_quality": ["sensor_id", "zone", "pm25", "pm10", "no2", "aqi", "timestamp"],
    "bus_gps": ["bus_id", "route_id", "lat", "lon", "speed_kmh", "occupancy_pct", "timestamp"],
}


def _dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Replays quarantine at the record's own event time (deterministic clock).
    return quality.dlq_records(_validated_streams(spark, sf_dir), RECORD_COLS,
                               clock=F.col("event_time"))


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined records of air_quality and bus_gps."""
    return _dlq(spark, sf_dir).select("error_reason", "source_topic", "source_partition",
                                      "source_offset",
                                      to_ntz("quarantined_at").alias("quarantined_at"), "original")


def dlq_error_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and share of the total per error reason."""
    out = quality.error_distribution(quality.report_counts(_dlq(spark, sf_dir)))
    return out.select("error_reason", "n", F.round("pct", 4).alias("pct"))


def dlq_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: quarantined records per source topic."""
    return quality.by_source_topic(quality.report_counts(_dlq(spark, sf_dir)))


def dlq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: good / bad totals of the validator."""
    return quality.good_bad_totals(_validated_streams(spark, sf_dir))


def dlq_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed-width report, as numbered lines, of what was
    quarantined in the last 300 seconds of the data."""
    dlq = _dlq(spark, sf_dir)
    newest = dlq.agg(F.max("quarantined_at")).scalar()
    recent = quality.within_last(dlq, DLQ_REPORT_WINDOW_SEC, as_of=newest)
    return quality.report_lines(quality.report_counts(recent), window_seconds=DLQ_REPORT_WINDOW_SEC)


def aqi_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced vs null-AQI readings per zone."""
    return quality.aqi_data_quality(td.air_quality(spark, sf_dir))


def _incident_out(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", to_ntz("event_time"))


def aqi_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hazardous AQI readings as incidents."""
    return _incident_out(detectors.aqi_emergencies(td.air_quality(spark, sf_dir)))


def bus_gps_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every GPS event with its route schedule (left outer)."""
    gps = td.bus_gps(spark, sf_dir).select("bus_id", "route_id", "lat", "lon", "speed_kmh",
                                           "occupancy_pct", "timestamp", "event_id")
    return enrich.enrich_bus_gps(gps, enrich.route_table(td.route_schedule(spark, sf_dir)))


def traffic_gridlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 3rd consecutive congested cycle per junction."""
    return _incident_out(detectors.gridlock_alerts(td.traffic_signals(spark, sf_dir)))


def bus_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching alerts with the default 300 s rule."""
    return _incident_out(bunching.bunching_alerts(td.bus_gps(spark, sf_dir)))


def bus_bunching_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 with an 86,400 s duration: multi-observation runs and restarts."""
    return _incident_out(bunching.bunching_alerts(td.bus_gps(spark, sf_dir), duration_sec=86_400))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.incident_feed(
        detectors.aqi_emergencies(td.air_quality(spark, sf_dir)),
        detectors.gridlock_alerts(td.traffic_signals(spark, sf_dir)),
        bunching.bunching_alerts(td.bus_gps(spark, sf_dir)))


def _feed_out(df: DataFrame) -> DataFrame:
    # Nullable integer columns are typed DOUBLE in the mixed feed so every
    # client decodes them the same way.
    return _incident_out(df).withColumn("consecutive_cycles", F.col("consecutive_cycles").cast("double"))


def incident_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three detectors' alerts as one feed."""
    return _feed_out(_feed(spark, sf_dir))


def latest_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 100 incidents, newest first (one top-100 over the
    union: the branches run in parallel and each task keeps at most 100 rows)."""
    return _feed_out(serving.latest(_feed(spark, sf_dir), serving.incident_order()))


def latest_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 100 health advisories."""
    adv = aggregates.health_advisories(td.air_quality(spark, sf_dir), td.zone_profile(spark, sf_dir))
    top = serving.latest(adv, [F.col("window_start").desc(), F.col("zone").asc()])
    return top.withColumn("window_start", to_ntz("window_start")).withColumn("window_end", to_ntz("window_end"))


def latest_ward_energy_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2+P18/Y5: numeric columns of the newest 100 ward summaries (chart data)."""
    ward = aggregates.ward_energy(td.smart_meters(spark, sf_dir))
    top = serving.latest(ward, [F.col("window_start").desc(), F.col("ward_id").asc()])
    top = top.select(*[F.round(c, 4).alias(c) if c != "ward_id" else c for c in top.columns
                       if c not in ("window_start", "window_end")])
    return serving.numeric_columns(top)


def _signals_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = td.traffic_signals(spark, sf_dir)
    # Raw topic values: whole records as compact JSON, keys in the producer's
    # order, with some unparsable payloads mixed in.
    value = F.when(F.col("event_id") % 41 == 0, F.lit("garbage text")).otherwise(
        payload_json("zone", "junction_id", "vehicle_count", "avg_wait_sec", "signal_phase", "timestamp"))
    return sig.select("topic", "partition", "offset", value.alias("value"))


def topic_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic tail lines — canonical JSON when parseable, else raw."""
    return serving.topic_view(_signals_envelope(spark, sf_dir))


def signal_adaptations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIGH-priority signal adaptations with partition/offset."""
    return serving.signal_adaptations(td.traffic_signals(spark, sf_dir))


def signal_partition_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per traffic_signals partition."""
    return serving.partition_throughput(td.traffic_signals(spark, sf_dir))


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag per consumer group over committed offsets.

    Committed offsets derive from the topic's end offsets: HIGH_PRIORITY
    trails each partition by its partition number, STANDARD_PRIORITY sits
    half-way on partition 0, past the end on 1, has no commit on 2 and one
    commit on a partition without an end offset; IDLE has no commits.
    """
    ends = serving.end_offsets(td.traffic_signals(spark, sf_dir))
    high, std = CONSUMER_GROUPS
    at = F.col("partition")
    commits = F.array(
        F.struct(F.lit(high).alias("group_id"), at.alias("partition"), (F.col("end_offset") - at).alias("committed_offset")),
        F.struct(F.lit(std).alias("group_id"), F.when(at == 2, at + 1).otherwise(at).alias("partition"),
                 F.when(at == 0, F.expr("end_offset div 2")).when(at == 1, F.col("end_offset") + 5)
                 .when(at == 2, F.lit(10)).cast("long").alias("committed_offset")))
    committed = ends.select("topic", F.inline(commits)).where("committed_offset IS NOT NULL")
    groups = spark.createDataFrame([(g,) for g in (*CONSUMER_GROUPS, "IDLE")], "group_id string")
    out = serving.consumer_lag(committed, ends, groups)
    return out.withColumn("lag", F.col("lag").cast("double"))  # nullable: typed DOUBLE


def zone_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain-language AQI status per zone from its latest rolling window."""
    out = serving.zone_status(aggregates.rolling_aqi(td.air_quality(spark, sf_dir)))
    return out.withColumn("window_start", to_ntz("window_start"))


def _rollup(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    out = history.ward_rollup(history.read_history(spark, _ward_history(spark, sf_dir)), unit)
    return out.select("ward_id", to_ntz("period_start").alias("period_start"),
                      *[F.round(c, 4).cast("double").alias(c) for c in ("total_kwh_consumed", "avg_power_factor",
                                                                        "peak_voltage")], "windows")


def ward_energy_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly ward aggregates recomputed from the Parquet history."""
    return _rollup(spark, sf_dir, "week")


def ward_energy_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly ward aggregates recomputed from the Parquet history."""
    return _rollup(spark, sf_dir, "month")


def buses_within_200m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of buses whose latest positions are within 200 m."""
    return history.buses_within(history.latest_positions(td.bus_gps(spark, sf_dir)), digits=4)


def redelivered_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once redeliveries (every 7th record sent twice) removed,
    first delivery kept."""
    aq = td.air_quality(spark, sf_dir).select("sensor_id", "timestamp", "aqi", "partition", "offset",
                                              "event_id")
    again = aq.where(F.col("event_id") % 7 == 0).withColumn("offset", F.col("offset") + 1_000_000)
    return history.first_deliveries(aq.unionByName(again).drop("event_id"), ["sensor_id", "timestamp"])


def bus_places_200m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bus with its place (class of equal positions) and its number of buses within 200 m."""
    return history.bus_places(history.latest_positions(td.bus_gps(spark, sf_dir)))


def places_within_200m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of places within 200 m; output grows with places, not with pairs of buses."""
    pairs = history.places_within(history.latest_positions(td.bus_gps(spark, sf_dir)))
    return pairs.withColumn("distance_m", F.round("distance_m", 4))


def health_advisories_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The advisories by SQL text over named relations."""
    out = relations.advisories_by_sql(spark, td.air_quality(spark, sf_dir), td.zone_profile(spark, sf_dir))
    return out.withColumn("window_start", to_ntz("window_start")).withColumn("window_end", to_ntz("window_end"))


def retention_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each of the nine datasets keeps under its retention, as of its
    newest record, planned over the date partitions of the written datasets."""
    air = td.air_quality(spark, sf_dir)
    derived = {
        "bus_gps_enriched": (bus_gps_enriched(spark, sf_dir), parse_event_time("timestamp")),
        "incidents": (_feed(spark, sf_dir), F.col("event_time")),
        "ward_energy_summary": (_ward_summary(spark, sf_dir), F.col("window_end")),
        "health_advisories": (aggregates.health_advisories(air, td.zone_profile(spark, sf_dir)), F.col("window_end")),
        "dlq": (_dlq(spark, sf_dir), F.col("quarantined_at")),
    }
    streams = {name: (f(spark, sf_dir), F.col("event_time")) for name, f in td.STREAMS.items()}
    rows = [df.select(F.lit(name).alias("dataset"), t.alias("event_time")) for name, (df, t) in {**streams, **derived}.items()]
    root = scratch_path(spark, "retention")
    retention.write_dated(reduce(DataFrame.unionByName, rows), root)
    return retention.summary(spark, root, retention.plan(spark, root, RETENTION_DAYS))


QUERIES: dict[str, Query] = {
    "ward_energy_15m": ward_energy_15m,
    "ward_energy_history": ward_energy_history,
    "aqi_rolling_10m": aqi_rolling_10m,
    "health_advisories": health_advisories,
    "dlq_records": dlq_records,
    "dlq_error_distribution": dlq_error_distribution,
    "dlq_by_topic": dlq_by_topic,
    "dlq_totals": dlq_totals,
    "dlq_report_text": dlq_report_text,
    "aqi_data_quality": aqi_data_quality,
    "aqi_emergency": aqi_emergency,
    "bus_gps_enriched": bus_gps_enriched,
    "traffic_gridlock": traffic_gridlock,
    "bus_bunching": bus_bunching,
    "bus_bunching_day": bus_bunching_day,
    "incident_feed": incident_feed,
    "latest_incidents": latest_incidents,
    "latest_advisories": latest_advisories,
    "latest_ward_energy_chart": latest_ward_energy_chart,
    "topic_view": topic_view,
    "signal_adaptations": signal_adaptations,
    "signal_partition_throughput": signal_partition_throughput,
    "consumer_lag": consumer_lag,
    "zone_status": zone_status,
    "ward_energy_weekly": ward_energy_weekly,
    "ward_energy_monthly": ward_energy_monthly,
    "buses_within_200m": buses_within_200m,
    "bus_places_200m": bus_places_200m,
    "places_within_200m": places_within_200m,
    "health_advisories_sql": health_advisories_sql,
    "redelivered_dedup": redelivered_dedup,
    "retention_summary": retention_summary,
}
