"""Streaming sources.

Every raw stream is a Kafka-shaped envelope (key, value, topic, partition,
offset, timestamp). With the Kafka connector on the classpath the envelope
comes from ``format("kafka")``; otherwise (and in tests) from files holding
the same columns, value as JSON text. Decoding is identical for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from citystream.config import STREAM_PARTITIONS
from citystream.functions.jsonfn import CORRUPT, decode_json
from citystream.functions.timefn import parse_event_time
from citystream.schemas import ROUTE_SCHEDULE, ZONE_PROFILE

# File twin of the envelope: value/key as text (Kafka gives binary; decode casts).
FILE_ENVELOPE = StructType([
    StructField("key", StringType()), StructField("value", StringType()),
    StructField("topic", StringType()), StructField("partition", IntegerType()),
    StructField("offset", LongType()), StructField("timestamp", TimestampType()),
])


def kafka_options(bootstrap: str | list[str], topics: str | list[str], starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Reader options for one or several topics (S1/S3); ``starting`` is
    'earliest' or 'latest' (S4). Consumer groups map to one checkpoint per
    query, so two queries on one topic never delay each other (T8). Lost
    offsets fail the query, Kafka's default; a caller may pass
    ``failOnDataLoss="false"`` to accept the loss."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    opts = {
        "kafka.bootstrap.servers": bootstrap if isinstance(bootstrap, str) else ",".join(bootstrap),
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def bounded_kafka_options(bootstrap: str | list[str], topics: str | list[str],
                          start_ms: int, end_ms: int) -> dict[str, str]:
    """S5 as a batch read: every record of the topics whose broker timestamp
    lies in [start_ms, end_ms)."""
    opts = kafka_options(bootstrap, topics, "earliest")
    opts.pop("startingOffsets")
    opts.update({"startingTimestamp": str(start_ms), "endingTimestamp": str(end_ms)})
    return opts


def read_envelope(spark: SparkSession, source: str, *, fmt: str = "kafka",
                  options: dict[str, str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelope. ``fmt='kafka'``: ``source`` is ignored and
    ``options`` come from :func:`kafka_options`; ``fmt='json'|'parquet'``:
    ``source`` is a folder of envelope files."""
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**(options or {})).load()
    reader = spark.readStream.schema(FILE_ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(source)


def record_id(partitions: int | None = None):
    """Unique record id from the envelope, ``offset * P + partition`` with
    ``P`` the topic's partition count: increasing with the offset inside a
    partition, hence along every key (a key lives in one partition)."""
    if partitions is not None:
        return F.col("offset") * F.lit(partitions) + F.col("partition")
    p = F.lit(1 << 16)
    for topic, n in STREAM_PARTITIONS.items():
        p = F.when(F.col("topic") == topic, F.lit(n)).otherwise(p)
    return F.col("offset") * p + F.col("partition")


def decode(envelope: DataFrame, schema: StructType, keep_corrupt: bool = False,
           partitions: int | None = None) -> DataFrame:
    """Value bytes -> typed record fields + ``event_time`` and the
    ``event_id`` tie-break; the envelope's topic/partition/offset are kept
    for DLQ and lag use. Malformed JSON yields ``_corrupt_record`` (kept
    when asked)."""
    d = envelope.select("topic", "partition", "offset",
                        decode_json(F.col("value").cast("string"), schema).alias("d"))
    cols = [F.col(f"d.{f.name}").alias(f.name) for f in schema.fields]
    if keep_corrupt:
        cols.append(F.col(f"d.{CORRUPT}").alias(CORRUPT))
    out = d.select("topic", "partition", "offset", *cols)
    return out.withColumn("event_time", parse_event_time("timestamp")) \
              .withColumn("event_id", record_id(partitions).cast("long"))


def read_lookup_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Lookup CSV with header and an explicit schema (never inferred:
    inference turns '08:15' into today's timestamp). Adds ``seq`` = file
    order, so later duplicates of a key can win."""
    schema = {"route_schedule": ROUTE_SCHEDULE, "zone_profile": ZONE_PROFILE}[kind]
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("seq", F.monotonically_increasing_id())
