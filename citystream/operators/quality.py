"""Record validation and the dead-letter queue."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.config import (AQI_MAX, AQI_MIN, AQI_OUT_OF_RANGE, IMPOSSIBLE_GPS, MALFORMED_JSON,
                               NULL_AQI, NULL_GPS)
from citystream.functions.jsonfn import CORRUPT, payload_json, with_json_field
from citystream.functions.textfmt import fixed_width_line

# Declarative rule table: per topic, (predicate, reason) in priority order;
# the first predicate that holds names the error. Topics without rules are
# always valid. Predicates are built lazily (Columns need a live session).
RULES: dict[str, list[tuple[Callable[[], Column], str]]] = {
    "air_quality": [
        (lambda: F.col("aqi").isNull(), NULL_AQI),
        (lambda: ~F.col("aqi").between(AQI_MIN, AQI_MAX), AQI_OUT_OF_RANGE),
    ],
    "bus_gps": [
        (lambda: F.col("lat").isNull() | F.col("lon").isNull(), NULL_GPS),
        (lambda: ~(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)),
         IMPOSSIBLE_GPS),
    ],
}
VALIDATED_TOPICS = tuple(RULES)


def error_reason(topic: str, columns: list[str]) -> Column:
    """Nullable reason column for a record of ``topic`` (null = valid).

    A ``_corrupt_record`` column, when present, routes unparsable input first.
    """
    rules = [(pred(), reason) for pred, reason in RULES.get(topic, [])]
    if CORRUPT in columns:
        rules.insert(0, (F.col(CORRUPT).isNotNull(), MALFORMED_JSON))
    if not rules:
        return F.lit(None).cast("string")
    expr = F.when(rules[0][0], F.lit(rules[0][1]))
    for pred, reason in rules[1:]:
        expr = expr.when(pred, F.lit(reason))
    return expr


def validate(df: DataFrame, topic: str) -> DataFrame:
    """Adds ``error_reason`` to every record of one topic."""
    return df.withColumn("error_reason", error_reason(topic, df.columns))


def dlq_envelope(validated: DataFrame, topic: str, record_cols: list[str],
                 clock: Column | None = None) -> DataFrame:
    """P7+P8: bad records only, wrapped with their source coordinates.

    ``original`` is the whole source record as JSON text (explicit nulls),
    which lets records of every topic share one DLQ table. ``clock`` defaults
    to processing time; replays pass a deterministic column.
    """
    clock = F.current_timestamp() if clock is None else clock
    original = (F.col(CORRUPT) if CORRUPT in validated.columns else None)
    payload = payload_json(*record_cols)
    if original is not None:
        payload = F.coalesce(original, payload)
    return (validated.where(F.col("error_reason").isNotNull())
            .select("error_reason",
                    F.lit(topic).alias("source_topic"),
                    F.col("partition").cast("int").alias("source_partition"),
                    F.col("offset").cast("long").alias("source_offset"),
                    clock.alias("quarantined_at"),
                    payload.alias("original")))


def dlq_records(streams: dict[str, DataFrame], record_cols: dict[str, list[str]],
                clock: Column | None = None) -> DataFrame:
    """Validate several topics and union their quarantined records."""
    parts = [dlq_envelope(validate(df, t), t, record_cols[t], clock) for t, df in streams.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def dlq_topic_records(dlq: DataFrame) -> DataFrame:
    """Quarantined records as topic records; ``original`` is the source
    record itself, a nested object (a string if it never parsed)."""
    rest = [F.col(c) for c in dlq.columns if c != "original"]
    value = with_json_field(payload_json(*rest), "original", F.col("original"))
    return dlq.select(F.lit(None).cast("string").alias("key"), value.alias("value"))


def good_bad_totals(streams: dict[str, DataFrame]) -> DataFrame:
    """A5: good / bad record totals over the validated topics (one row)."""
    parts = [validate(df, t).select(F.col("error_reason").isNull().alias("ok"))
             for t, df in streams.items()]
    allv = reduce(lambda a, b: a.unionByName(b), parts)
    return allv.agg(F.count_if(F.col("ok")).alias("good"), F.count_if(~F.col("ok")).alias("bad"))


def within_last(dlq: DataFrame, seconds: int, as_of: Column | None = None) -> DataFrame:
    """Bounded read — records quarantined in the last ``seconds`` before ``as_of``."""
    as_of = F.current_timestamp() if as_of is None else as_of  # may be a scalar subquery
    return dlq.where(F.col("quarantined_at") >= as_of - F.make_dt_interval(secs=F.lit(seconds)))


def report_counts(dlq: DataFrame) -> DataFrame:
    """A3+A4+total in one scan: GROUPING SETS ((reason), (topic), ()).

    Returns ``dimension`` ('reason' | 'topic' | 'total'), ``label``, ``n`` and
    ``pct`` (share of the total, in percent; reasons only). Missing reason or
    topic counts as 'UNKNOWN' (P16).
    """
    base = dlq.select(F.coalesce("error_reason", F.lit("UNKNOWN")).alias("reason"),
                      F.coalesce("source_topic", F.lit("UNKNOWN")).alias("topic"))
    g = base.groupingSets([["reason"], ["topic"], []], "reason", "topic").agg(
        F.count("*").alias("n"), F.grouping_id().alias("gid"))
    # gid bits: reason=2, topic=1 -> (reason) set has gid 1, (topic) 2, () 3.
    labelled = g.select(
        F.when(F.col("gid") == 1, "reason").when(F.col("gid") == 2, "topic")
        .otherwise("total").alias("dimension"),
        F.when(F.col("gid") == 1, F.col("reason")).when(F.col("gid") == 2, F.col("topic"))
        .alias("label"),
        "n")
    # The grouped table has one row per reason/topic plus one: tiny.
    total = F.max(F.when(F.col("dimension") == "total", F.col("n"))).over(Window.partitionBy())
    return labelled.withColumn(
        "pct", F.when(F.col("dimension") == "reason", F.col("n") * 100.0 / total))


def error_distribution(counts: DataFrame) -> DataFrame:
    """Reasons, most common first (ties by name)."""
    return (counts.where(F.col("dimension") == "reason")
            .select(F.col("label").alias("error_reason"), "n", "pct")
            .orderBy(F.desc("n"), F.asc("error_reason")))


def by_source_topic(counts: DataFrame) -> DataFrame:
    """A4: quarantined records per source topic, most common first."""
    return (counts.where(F.col("dimension") == "topic")
            .select(F.col("label").alias("source_topic"), "n")
            .orderBy(F.desc("n"), F.asc("source_topic")))


def report_lines(counts: DataFrame, window_seconds: int) -> DataFrame:
    """The fixed-width report body as ordered text lines.

    Columns ``line_no`` and ``line``; the (tiny) result is ordered by
    ``line_no`` and can be written with ``write.text`` after ``coalesce(1)``.
    """
    rule, thin = "=" * 50, "-" * 50
    # The counts are one row per reason and topic: gathered once, a section each.
    one = counts.agg(F.collect_list(F.struct((-F.col("n")).alias("o"), "label", "n", "pct", "dimension")).alias("all"),
                     F.coalesce(F.max(F.when(F.col("dimension") == "total", F.col("n"))), F.lit(0)).alias("total"))

    def section(dimension: str, line) -> Column:
        own = F.array_sort(F.filter("all", lambda x: x["dimension"] == dimension))
        return F.transform(own, line)

    def text(*lines) -> Column:
        return F.array(*(x if isinstance(x, Column) else F.lit(x) for x in lines))

    lines = F.concat(
        text(rule, "City stream DLQ Report", f"Window    : {window_seconds} seconds",
             F.concat(F.lit("Total bad records: "), F.col("total").cast("string")), thin, "Error type distribution:"),
        section("reason", lambda x: fixed_width_line(x["label"], x["n"], 18, x["pct"])),
        text(thin, "By source topic:"),
        section("topic", lambda x: fixed_width_line(x["label"], x["n"], 28)),
        text(rule))
    return one.select(F.posexplode(lines).alias("n", "line")).select((F.col("n") + 1).cast("long").alias("line_no"), "line")


def aqi_data_quality(air: DataFrame, by: tuple[str, ...] = ("zone",)) -> DataFrame:
    """Readings produced vs null-AQI readings per group."""
    return air.groupBy(*by).agg(F.count("*").alias("produced"),
                                F.count_if(F.col("aqi").isNull()).alias("null_aqi"))
