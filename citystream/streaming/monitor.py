"""Live operation: lag and throughput of running queries (A6, A7), and an audit
of what a checkpoint holds (T11)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from citystream.config import WARD_WINDOW
from citystream.operators import aggregates, serving

OFFSETS = ("group_id string, batch long, at timestamp, topic string, partition int, start_offset long, "
           "committed_offset long, end_offset long, messages long")


def offset_rows(group: str, batch: int, at: str, source: dict) -> list[tuple]:
    """The rows of one source of one progress report. Offsets by topic and
    partition (a topic's JSON) stay so; a plain number, as of files, is partition
    0 of the source. ``messages``, the rows read, is told once, by the first row."""
    def by_partition(text: str | dict | int | None) -> dict:
        found = json.loads(text) if isinstance(text, str) else text
        if isinstance(found, dict) and set(found) <= {"logOffset", "offset"}:
            found = next(iter(found.values()), None)
        if isinstance(found, dict):
            return {(t, int(p)): int(n) for t, parts in found.items() for p, n in parts.items()}
        return {} if found is None else {(source["description"], 0): int(found)}

    start, end, latest = (by_partition(source.get(k)) for k in ("startOffset", "endOffset", "latestOffset"))
    return [(group, batch, at, t, p, start.get((t, p)), end.get((t, p)), max(latest.get((t, p), n), n), 0 if i else int(source["numInputRows"]))
            for i, ((t, p), n) in enumerate(sorted({**latest, **end}.items()))]


class OffsetLog(StreamingQueryListener):
    """Writes every progress report's offsets below ``root``, a folder per query
    run and batch, replaced if a batch is told again. The query's name is the
    consumer group. A report is a few rows (the sources' partitions)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [r for s in json.loads(p.json)["sources"] for r in offset_rows(p.name or str(p.id), p.batchId, p.timestamp, s)]
        if rows:
            schema = OFFSETS.replace("at timestamp", "at string")
            (self.spark.createDataFrame(rows, schema).withColumn("at", F.to_timestamp("at")).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.root}/run={p.id}/id={p.batchId}"))

    def onQueryTerminated(self, event) -> None:
        pass


def read_offsets(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(OFFSETS).option("recursiveFileLookup", "true").parquet(root)


def live_lag(offsets: DataFrame, groups: DataFrame) -> DataFrame:
    """A6 live: each group's lag by its newest committed offsets. A partition's
    end is the furthest that any group's report has told of it."""
    committed = (offsets.where("committed_offset IS NOT NULL").groupBy("group_id", "topic", "partition")
                 .agg(F.max_by("committed_offset", F.struct("batch", "at")).alias("committed_offset")))
    ends = offsets.groupBy("topic", "partition").agg(F.max("end_offset").alias("end_offset"))
    return serving.consumer_lag(committed, ends, groups)


def group_throughput(offsets: DataFrame) -> DataFrame:
    """A7 live: per group the messages read and the batches that read them."""
    return offsets.groupBy("group_id").agg(F.sum("messages").alias("messages"), F.countDistinct("batch").alias("batches"))


def audit_ward_state(spark: SparkSession, checkpoint: str, meters: DataFrame, window: str = WARD_WINDOW) -> DataFrame:
    """The open windows that a ward energy query's checkpoint holds, read
    from its state store, against those of the ``meters`` it has consumed:
    one row per (window, ward) that differs, or that the checkpoint has and the
    source doesn't, or the source has, no earlier than the oldest kept, and the
    checkpoint doesn't. No row: the state is what the source says it should be.
    Sums are compared to nine digits, as their order differs."""
    state = spark.read.format("statestore").load(checkpoint)
    # The buffers' names repeat, so they are renamed by place.
    buffers = F.col("value").cast("struct<kwh: double, pf: double, n: bigint, volts: double>")
    window_key, ward_key = state.schema["key"].dataType.names
    held = (state.select(F.col("key")[ward_key].alias("ward_id"), F.col("key")[window_key]["start"].alias("window_start"), buffers.alias("v"))
            .select("ward_id", "window_start", F.col("v.kwh").alias("h_kwh"), (F.col("v.pf") / F.col("v.n")).alias("h_pf"),
                    F.col("v.volts").alias("h_volts")))
    due = aggregates.ward_energy(meters, window).select("ward_id", "window_start", "total_kwh_consumed", "avg_power_factor", "peak_voltage")
    oldest = held.agg(F.min("window_start").alias("oldest"))  # one row
    due = due.join(F.broadcast(oldest), F.col("window_start") >= F.col("oldest")).drop("oldest")
    both = held.alias("h").join(due.alias("d"), F.col("h.ward_id").eqNullSafe(F.col("d.ward_id"))
                                & (F.col("h.window_start") == F.col("d.window_start")), "full")

    def same(a: str, b: str):
        x, y = F.col(a), F.col(b)
        return x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y)) * F.lit(1e-9), F.lit(False))

    alike = same("h_kwh", "total_kwh_consumed") & same("h_pf", "avg_power_factor") & same("h_volts", "peak_voltage")
    missing = F.col("h.window_start").isNull() | F.col("d.window_start").isNull()
    return both.where(missing | ~alike).select(
        F.coalesce("h.ward_id", "d.ward_id").alias("ward_id"), F.coalesce("h.window_start", "d.window_start").alias("window_start"),
        "h_kwh", "total_kwh_consumed", "h_pf", "avg_power_factor", "h_volts", "peak_voltage")
