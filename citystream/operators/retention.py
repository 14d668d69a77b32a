"""Retention by date partition.

A dataset lies below ``<root>/dataset=<name>/date=<day>``. Its cutoff is the
newest event time less its days. :func:`plan` decides from the list of
partitions alone: days before the cutoff's go, days after it stay, and only the
cutoff's own day holds rows of both kinds and is rewritten. No file of a whole
partition is read, but for the newest day's times.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How Spark names the partition of rows without an event time; nothing keeps those.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def write_dated(rows: DataFrame, root: str) -> None:
    """``rows`` (dataset, event_time and others) by dataset and day; a task holds whole days or
    an eighth of one, so a day that has most rows is written by several."""
    (rows.withColumn("date", F.to_date("event_time"))
     .repartition("dataset", "date", F.pmod(F.hash("event_time"), F.lit(8)))
     .write.partitionBy("dataset", "date").parquet(root))


@dataclass
class Plan:
    """What becomes of the days of one dataset; ``cutoff`` is None for one without a time."""
    dataset: str
    days: int
    cutoff: dt.datetime | None
    drop: list[str] = field(default_factory=list)
    keep: list[str] = field(default_factory=list)
    rewrite: list[str] = field(default_factory=list)


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def partitions(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The days each dataset has a folder for: one entry per day, no data file opened."""
    fs, path = _fs(spark, root)
    found: dict[str, list[str]] = {}
    for status in fs.globStatus(path(f"{root}/dataset=*/date=*")) or []:
        day = status.getPath()
        found.setdefault(day.getParent().getName().split("=", 1)[1], []).append(day.getName().split("=", 1)[1])
    return {name: sorted(days) for name, days in found.items()}


def _days(spark: SparkSession, root: str, dataset: str, days: list[str]) -> DataFrame:
    """The rows of some days; no other folder is listed."""
    return spark.read.option("basePath", root).parquet(*[f"{root}/dataset={dataset}/date={d}" for d in days])


def recover(spark: SparkSession, root: str) -> None:
    """Undo what an interrupted :func:`apply` has left: a day that was taken
    away and not replaced comes back, all else it put aside goes."""
    fs, path = _fs(spark, root)
    for status in fs.globStatus(path(f"{root}/_expired/dataset=*/date=*")) or []:
        old = status.getPath()
        day = path(f"{root}/{old.getParent().getName()}/{old.getName()}")
        if not fs.exists(day):
            fs.rename(old, day)
    for name in ("_expired", "_retained"):
        fs.delete(path(f"{root}/{name}"), True)


def plan(spark: SparkSession, root: str, retention_days: dict[str, int], as_of: dt.datetime | None = None) -> list[Plan]:
    """One :class:`Plan` per dataset with a partition. ``as_of`` (UTC) defaults
    to each dataset's newest event time, read from its newest day."""
    recover(spark, root)
    plans = []
    for dataset, days in sorted(partitions(spark, root).items()):
        dated = [d for d in days if d != NO_DATE]
        n = retention_days[dataset]
        cutoff = None
        if dated:
            newest = F.lit(as_of).cast("timestamp") if as_of else F.max("event_time")
            rows = _days(spark, root, dataset, dated[-1:])
            cutoff = rows.agg((newest - F.make_dt_interval(days=F.lit(n))).cast("timestamp_ntz").alias("c")).first().c
        p = Plan(dataset, n, cutoff)
        for d in days:
            if d == NO_DATE or d < str(cutoff.date()):
                p.drop.append(d)
            else:
                (p.rewrite if d == str(cutoff.date()) else p.keep).append(d)
        plans.append(p)
    return plans


def _kept(spark: SparkSession, root: str, p: Plan) -> DataFrame:
    """The cutoff's day without the rows before it."""
    return _days(spark, root, p.dataset, p.rewrite).drop("dataset", "date").where(F.col("event_time").cast("timestamp_ntz") >= F.lit(p.cutoff).cast("timestamp_ntz"))


def summary(spark: SparkSession, root: str, plans: list[Plan]) -> DataFrame:
    """dataset, retention_days, total, retained. Whole days count by their
    files' footers; only the cutoff's day has its times read."""
    out = None
    for p in plans:
        whole = [(days, flag) for days, flag in ((p.drop, 0), (p.keep, 1), (p.rewrite, 0)) if days]
        parts = [_days(spark, root, p.dataset, days).agg(F.count("*").alias("total")).select("total", (F.col("total") * flag).alias("retained"))
                 for days, flag in whole]
        if p.rewrite:
            parts.append(_kept(spark, root, p).agg(F.count("*").alias("retained")).select(F.lit(0).cast("long").alias("total"), "retained"))
        for part in parts:
            row = part.select(F.lit(p.dataset).alias("dataset"), F.lit(p.days).alias("retention_days"), "total", "retained")
            out = row if out is None else out.unionByName(row)
    if out is None:
        return spark.createDataFrame([], "dataset string, retention_days int, total long, retained long")
    return out.groupBy("dataset", "retention_days").agg(F.sum("total").alias("total"), F.sum("retained").alias("retained"))


def apply(spark: SparkSession, root: str, plans: list[Plan]) -> None:
    """Carry plans out: the kept rows of the cutoff's day are written aside and
    put in its place, expired days are removed. One that was interrupted is put
    right by the next :func:`plan`, so no row within its days is lost."""
    fs, path = _fs(spark, root)
    for p in plans:
        for d in p.rewrite:
            place = f"dataset={p.dataset}/date={d}"
            _kept(spark, root, p).write.mode("overwrite").parquet(f"{root}/_retained/{place}")
            old = path(f"{root}/_expired/{place}")
            fs.mkdirs(old.getParent())
            for a, b in ((path(f"{root}/{place}"), old), (path(f"{root}/_retained/{place}"), path(f"{root}/{place}"))):
                if not fs.rename(a, b):
                    raise OSError(f"cannot move {a.toString()} to {b.toString()}")
            fs.delete(old, True)
        for d in p.drop:
            fs.delete(path(f"{root}/dataset={p.dataset}/date={d}"), True)
    recover(spark, root)
