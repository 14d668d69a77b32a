"""Sinks (K1-K3, K5, K7-K10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.jsonfn import payload_json


def kafka_sink_options(bootstrap: str | list[str], topic: str, retries: int = 3,
                       backoff_ms: int = 500) -> dict[str, str]:
    """Topic writer options; acks=all with bounded retries. The Kafka
    sink is at-least-once; duplicates are removed downstream (T9)."""
    return {
        "kafka.bootstrap.servers": bootstrap if isinstance(bootstrap, str) else ",".join(bootstrap),
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": str(retries),
        "kafka.retry.backoff.ms": str(backoff_ms),
    }


def as_topic_records(df: DataFrame, key: str | Column | None = None, keep_nulls: bool = False) -> DataFrame:
    """K1/K2/K3: rows -> (key, value) text. A key pins every record of that
    key to one partition, which preserves per-key order for consumers."""
    value = payload_json(*[F.col(c) for c in df.columns], keep_nulls=keep_nulls)
    k = (F.col(key) if isinstance(key, str) else key) if key is not None else F.lit(None)
    return df.select(k.cast("string").alias("key"), value.alias("value"))


def keyed_layout(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """K3 file twin: co-locate each key in one output partition, sorted, so
    a file reader sees the same per-key order a keyed topic guarantees."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """Names one micro-batch of one checkpoint, the same on every attempt."""
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


def batch_place(target: str, batch: DataFrame, batch_id: int) -> str:
    """The folder of one micro-batch below ``target``. The query id lasts as
    long as the checkpoint, so a replay finds its own folder and no other."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{target}/run={run}/batch={batch_id}"


def write_topic_batch(records: DataFrame, fmt: str, target: str, options: dict[str, str] | None = None) -> None:
    """K2: write one micro-batch (or batch) of (key, value) records to a topic
    (``fmt='kafka'``, ``target`` unused) or to a JSON folder standing in for
    it, which is replaced."""
    if fmt == "kafka":
        records.write.format("kafka").options(**(options or {})).save()
    else:
        records.write.mode("overwrite").json(target)


def write_report(lines: DataFrame, path: str) -> None:
    """K8: the (tiny, ordered) report as one text file, replaced each run."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
