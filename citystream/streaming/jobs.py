"""Streaming queries wiring sources, operators and sinks (E1-E5, K5, K9, T1,
T3, T6-T10). Each builder returns a configured ``DataStreamWriter``; the
caller picks the trigger (continuous micro-batches by default, T10;
``availableNow`` for replays and tests) and starts it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from citystream.config import AQI_UNHEALTHY, WARD_WINDOW, WATERMARK_DELAY
from citystream.operators import aggregates, detectors, enrich, history, quality, serving
from citystream.session import checkpoint_location
from citystream.streaming import maintained, sinks, stateful

DETECTOR_WATERMARK = "5 seconds"  # bounds ordering metadata only; detectors drop nothing


def _writer(df: DataFrame, name: str, mode: str) -> DataStreamWriter:
    spark = df.sparkSession
    return (df.writeStream.queryName(name).outputMode(mode)
            .option("checkpointLocation", checkpoint_location(spark, name)))


def ward_energy_batch_writer(history_path: str, topic_fmt: str, topic_target: str,
                             topic_options: dict[str, str] | None = None):
    """K5: one micro-batch to Parquet history and to the summary topic.

    Every batch is executed, a replayed one too, so the state store commits
    with it. Both file sinks write the batch to its own place (query id, batch
    id), replacing what a half-finished attempt has left there; a Kafka topic
    is at-least-once. Another checkpoint has another query id, so two queries,
    or a restart from nothing, never meet in one place. Empty batches write
    nothing.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = aggregates.with_partition_date(batch).persist()
        try:
            if out.isEmpty():
                return
            history.write_history(out, sinks.batch_place(history_path, batch, batch_id), mode="overwrite")
            sinks.write_topic_batch(sinks.as_topic_records(out, key="ward_id"), topic_fmt,
                                    sinks.batch_place(topic_target, batch, batch_id), topic_options)
        finally:
            out.unpersist()

    return write_batch


def ward_energy_query(meters: DataFrame, history_path: str, topic_fmt: str, topic_target: str,
                      window: str = WARD_WINDOW, delay: str = WATERMARK_DELAY,
                      name: str = "ward_energy") -> DataStreamWriter:
    """E1 (T1/T3/T6/W1/A1/K4/K5): watermark, 15-minute windows in append
    mode — each window is emitted once, after the watermark passes its end."""
    agg = aggregates.ward_energy(meters.withWatermark("event_time", delay), window)
    return _writer(agg, name, "append").foreachBatch(
        ward_energy_batch_writer(history_path, topic_fmt, topic_target))


def advisory_query(air: DataFrame, zones: DataFrame, threshold: float = AQI_UNHEALTHY,
                   delay: str = WATERMARK_DELAY, name: str = "health_advisories") -> DataFrame:
    """E2 (T7): sliding-window advisories in update mode. A window is
    re-emitted whenever its average changes while above the threshold; no
    retraction is sent when it falls back (consumers upsert on zone+window)."""
    return aggregates.health_advisories(air.withWatermark("event_time", delay), zones, threshold)


def emergency_stream(air: DataFrame) -> DataFrame:
    """P4 streaming: stateless, append."""
    return detectors.aqi_emergencies(air)


def gridlock_incidents(signals: DataFrame, in_order: bool = False) -> DataFrame:
    """T4; ``in_order``: by event time, arrival disorder within the watermark changes nothing."""
    rows = signals.withWatermark("event_time", DETECTOR_WATERMARK)
    return stateful.gridlock_in_order(rows) if in_order else stateful.gridlock_stream(rows)


def bunching_incidents(gps: DataFrame, duration_sec: int | None = None, in_order: bool = False) -> DataFrame:
    """T5; ``in_order`` as above."""
    kw = {} if duration_sec is None else {"duration_sec": duration_sec}
    return stateful.bunching_stream(gps.withWatermark("event_time", DETECTOR_WATERMARK), in_order=in_order, **kw)


def enrichment_stream(gps: DataFrame, routes: DataFrame) -> DataFrame:
    """E5 (J1): stream-static left join; emit keyed by route_id (K3)."""
    return enrich.enrich_bus_gps(gps, enrich.route_table(routes))


def dlq_batch_writer(record_cols: dict[str, list[str]], dlq_fmt: str, dlq_target: str,
                     dlq_options: dict[str, str] | None = None):
    """E4 (P6-P8, A5): per micro-batch, route bad records of each topic to the
    DLQ sink. Good records are only counted (observed metrics)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            parts = {t: b.where(F.col("topic") == t) for t in record_cols}
            bad = quality.dlq_records(parts, record_cols)
            sinks.write_topic_batch(quality.dlq_topic_records(bad), dlq_fmt,
                                    sinks.batch_place(dlq_target, batch, batch_id), dlq_options)
        finally:
            b.unpersist()

    return write_batch


def dlq_query(records: DataFrame, record_cols: dict[str, list[str]], dlq_fmt: str, dlq_target: str,
              name: str = "dlq_validator") -> DataStreamWriter:
    """``records``: decoded rows of the validated topics with a ``topic``
    column. Running good/bad totals are published as observed metrics."""
    reason = F.coalesce(*[F.when(F.col("topic") == t, quality.error_reason(t, records.columns))
                          for t in record_cols])
    observed = records.observe("dlq_totals", F.count_if(reason.isNull()).alias("good"),
                               F.count_if(reason.isNotNull()).alias("bad"))
    return _writer(observed, name, "append").foreachBatch(dlq_batch_writer(record_cols, dlq_fmt, dlq_target))


def dedup_stream(records: DataFrame, keys: list[str], delay: str = WATERMARK_DELAY) -> DataFrame:
    """T9/X4 streaming: drop redelivered copies (at-least-once sources)
    whose first copy arrived within the watermark delay; state for a key is
    evicted once the watermark passes, so it stays bounded. Records with a
    null key part can't be told apart and all pass."""
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own = F.when(unkeyed, F.concat_ws("/", "topic", "partition", "offset"))
    return (records.withColumn("_own", own).withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark([*keys, "_own"]).drop("_own"))


def consumer_group_queries(signals_for_group, sink_root: str, trigger: dict | None = None,
                           pools: tuple[str, str] = ("high", "standard")) -> list:
    """Two independent consumer groups on one topic, started and returned.

    Each group is its own query (own source instance and checkpoint) started
    from its own scheduler pool (a thread-local property read at start), so
    a slow STANDARD group never delays HIGH_PRIORITY. ``signals_for_group``
    returns a fresh decoded stream for a group. HIGH_PRIORITY emits signal
    adaptations (P5); STANDARD_PRIORITY keeps message counts per partition (A7).
    """
    started = []
    for group, pool in zip(("HIGH_PRIORITY", "STANDARD_PRIORITY"), pools):
        stream = signals_for_group(group)
        sc = stream.sparkSession.sparkContext
        if group == "HIGH_PRIORITY":
            out, mode = serving.signal_adaptations(stream), "append"
        else:
            out, mode = serving.partition_throughput(stream), "complete"
        target = f"{sink_root}/{group}"

        def sink(batch, batch_id, target=target, whole=mode == "complete"):
            place = target if whole else sinks.batch_place(target, batch, batch_id)
            batch.write.mode("overwrite").parquet(place)

        w = _writer(out, f"signals_{group}_{sink_root.rstrip('/').rpartition('/')[2]}", mode).foreachBatch(sink)
        if trigger:
            w = w.trigger(**trigger)
        sc.setLocalProperty("spark.scheduler.pool", pool)
        try:
            started.append(w.start())
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
    return started


def topic_query(rows: DataFrame, key: str | None, fmt: str, target: str, name: str, mode: str = "append",
                options: dict[str, str] | None = None) -> DataStreamWriter:
    """K1/K3/K6: a derived stream (advisories by zone, enriched positions by
    route, incidents) to its topic, as keyed JSON records, batch by batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        sinks.write_topic_batch(sinks.as_topic_records(batch, key=key, keep_nulls=True), fmt,
                                sinks.batch_place(target, batch, batch_id), options)

    return _writer(rows, name, mode).foreachBatch(sink)


def incident_queries(air: DataFrame, signals: DataFrame, gps: DataFrame, sink_root: str,
                     name: str = "incidents", bunching_sec: int | None = None,
                     trigger: dict | None = None, topic_fmt: str | None = None, topic_target: str | None = None,
                     topic_options: dict[str, str] | None = None) -> list:
    """U1/K6 streaming: the three detectors feed one incidents table, each as
    its own query (own checkpoint, own pace) writing the unified incident schema
    below ``sink_root`` (read that folder as one table) and, if ``topic_fmt`` is
    given, to one topic. :func:`incident_query` is all of them in one query."""
    started = []
    for part, df in (("aqi", emergency_stream(air)), ("gridlock", gridlock_incidents(signals)),
                     ("bunching", bunching_incidents(gps, bunching_sec))):
        feed = detectors.incident_feed(df)
        target = f"{sink_root}/detector={part}"

        def sink(batch, batch_id, target=target):
            batch = batch.persist()
            try:
                batch.write.mode("overwrite").parquet(sinks.batch_place(target, batch, batch_id))
                if topic_fmt:
                    sinks.write_topic_batch(sinks.as_topic_records(batch, keep_nulls=True), topic_fmt,
                                            sinks.batch_place(topic_target, batch, batch_id), topic_options)
            finally:
                batch.unpersist()

        w = _writer(feed, f"{name}_{part}", "append").foreachBatch(sink)
        started.append((w.trigger(**trigger) if trigger else w).start())
    return started


def incident_rows(air: DataFrame, signals: DataFrame, gps: DataFrame, bunching_sec: int | None = None,
                  in_order: bool = False) -> DataFrame:
    """U1 streaming: the three detectors' alerts as one stream. All keyed state
    is in ``transformWithState`` operators, which may stand in chains and beside
    each other in one query, so the stream has one query id and one checkpoint."""
    watermarked = signals.withWatermark("event_time", DETECTOR_WATERMARK)
    return detectors.incident_feed(emergency_stream(air), stateful.gridlock_in_order(watermarked, in_order=in_order),
                                   bunching_incidents(gps, bunching_sec, in_order))


def incident_query(air: DataFrame, signals: DataFrame, gps: DataFrame, sink_root: str, name: str = "incident_feed",
                   bunching_sec: int | None = None, in_order: bool = False, topic_fmt: str | None = None,
                   topic_target: str | None = None, topic_options: dict[str, str] | None = None,
                   latest_root: str | None = None) -> DataStreamWriter:
    """One query from three sources to one incident table below
    ``sink_root`` (a folder per batch, replaced on replay), if ``topic_fmt`` is
    given to one topic, and if ``latest_root`` is given to a maintained table of
    the newest incidents (O2, Y5), all from the same micro-batch."""
    def sink(batch, batch_id):
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(sinks.batch_place(sink_root, batch, batch_id))
            if topic_fmt:
                sinks.write_topic_batch(sinks.as_topic_records(batch, keep_nulls=True), topic_fmt,
                                        sinks.batch_place(topic_target, batch, batch_id), topic_options)
            if latest_root:
                maintained.keep_latest(batch, latest_root, serving.incident_order(), sinks.batch_name(batch, batch_id))
        finally:
            batch.unpersist()

    return _writer(incident_rows(air, signals, gps, bunching_sec, in_order), name, "append").foreachBatch(sink)


def upsert_query(rows: DataFrame, keys: list[str], root: str, part_by: str, name: str, mode: str = "update") -> DataStreamWriter:
    """A stream that emits a row again when it changes (advisories by zone
    and window start) as a table with the newest row of each key. ``part_by``
    is the date column whose parts are rewritten when touched."""
    def sink(batch, batch_id):
        maintained.upsert(batch, root, keys, part_by, sinks.batch_name(batch, batch_id))

    return _writer(rows, name, mode).foreachBatch(sink)
