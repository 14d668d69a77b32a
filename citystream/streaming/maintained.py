"""Tables kept up to date batch by batch (O2/Y5, T7, X1): every merge reads
only the parts that the batch touches, writes them anew and swaps them in.

A table is a folder of parts. ``manifests/<version>.json`` names, for each
part, the folder that holds it, and the batches merged so far; the manifest
with the highest number is the table. A merge writes new part folders first and
its manifest last, by a rename that fails if another has taken the number. So
a reader sees a whole version or the one before, a crash between the two leaves
folders that nothing names, and a batch that the manifest lists already changes
nothing when it is replayed. One writer per table at a time, as ``foreachBatch``
has it; a second one's merge fails rather than lose the first one's.

The manifest lists parts, not files or rows: with parts by date its size is the
number of days. ``batches`` keeps the last batch id of every query.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.config import SERVING_LATEST_N
from citystream.operators import history, serving

KEPT_VERSIONS = 3
#: The part of rows without a date.
NO_PART = "none"
#: Tasks, and files, that share the writing of one part.
SPREAD = 8


class Table:
    """The manifest of one maintained table; rows are read and written by Spark."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.version, self.parts, self.batches = 0, {}, {}
        for version in sorted(self._versions(), reverse=True)[:1]:
            text = spark.read.text(f"{self.root}/manifests/{version:012d}.json", wholetext=True).first()[0]
            found = json.loads(text)
            self.version, self.parts, self.batches = version, found["parts"], found["batches"]

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _versions(self) -> list[int]:
        folder = self._path("manifests")
        if not self.fs.exists(folder):
            return []
        return [int(n[:-5]) for s in self.fs.listStatus(folder) if (n := s.getPath().getName()).endswith(".json") and n[:-5].isdigit()]

    def has(self, batch: str) -> bool:
        """Whether ``batch`` (query id, number) has been merged."""
        query, number = batch.rsplit("-", 1)
        return int(number) <= self.batches.get(query, -1)

    def read(self, schema, parts: list[str] | None = None) -> DataFrame:
        """The rows of some parts (default all); no other part's files are listed."""
        folders = [f"{self.root}/{self.parts[p]}" for p in (self.parts if parts is None else parts) if p in self.parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def commit(self, written: dict[str, str], batch: str) -> None:
        """Swap ``written`` (part: folder) in as the next version."""
        query, number = batch.rsplit("-", 1)
        manifest = {"parts": {**self.parts, **written}, "batches": {**self.batches, query: int(number)}}
        own = self._path(f"manifests/.{uuid.uuid4().hex}")
        out = self.fs.create(own, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        target = self._path(f"manifests/{self.version + 1:012d}.json")
        if self.fs.exists(target) or not self.fs.rename(own, target):
            raise RuntimeError(f"another writer has merged into {self.root}")
        self._drop_old(self.version + 1)
        self.version, self.parts, self.batches = self.version + 1, manifest["parts"], manifest["batches"]

    def _drop_old(self, newest: int) -> None:
        """Remove the part folder that a version replaced once no kept version names it."""
        for version in self._versions():
            if version <= newest - KEPT_VERSIONS:
                old, after = (self._manifest(v) for v in (version, version + 1))
                for part, folder in old.items():
                    if after.get(part, folder) != folder:
                        self.fs.delete(self._path(folder), True)
                self.fs.delete(self._path(f"manifests/{version:012d}.json"), False)

    def _manifest(self, version: int) -> dict[str, str]:
        return json.loads(self.spark.read.text(f"{self.root}/manifests/{version:012d}.json", wholetext=True).first()[0])["parts"]


def read_table(spark: SparkSession, root: str, schema) -> DataFrame:
    """The newest version of a maintained table."""
    return Table(spark, root).read(schema)


def _part_of(column: str) -> Column:
    """The part of a row: the day of a date or time column, as text fit for a folder's name."""
    return F.coalesce(F.to_date(column).cast("string"), F.lit(NO_PART))


def _write(rows: DataFrame, table: Table, parts: list[str], part_col: str) -> dict[str, str]:
    """Rows written by part into a new folder; its name for each part."""
    folder = f"data/{uuid.uuid4().hex}"
    (rows.withColumn("_part", _part_of(part_col))
     .repartition("_part", F.pmod(F.hash(*rows.columns), F.lit(SPREAD))).write.partitionBy("_part").parquet(f"{table.root}/{folder}"))
    return {p: f"{folder}/_part={p}" for p in parts}




def keep_latest(batch: DataFrame, root: str, order: list[Column], name: str, n: int = SERVING_LATEST_N) -> None:
    """Merge ``batch`` into the table of the newest ``n`` rows: reads
    those ``n`` rows and the batch, whatever history there is. ``order`` must be
    a total order; a row in two batches counts twice, as in the feed."""
    table = Table(batch.sparkSession, root)
    if table.has(name) or batch.isEmpty():
        return
    newest = serving.latest(table.read(batch.schema).unionByName(batch), order, n)
    folder = f"data/{uuid.uuid4().hex}"
    newest.coalesce(1).write.parquet(f"{table.root}/{folder}")
    table.commit({"latest": folder}, name)


def _touched(batch: DataFrame, part_by: str) -> list[str]:
    # One value per date in the batch: bounded by the span of a micro-batch.
    return [r[0] for r in batch.select(_part_of(part_by)).distinct().collect()]


def upsert(batch: DataFrame, root: str, keys: list[str], part_by: str, name: str) -> None:
    """``batch``'s rows replace those of the same ``keys`` (nulls equal); of
    several in the batch any one stays, as update mode emits a key once a batch.
    Only parts (days of the date or time column ``part_by``, a function of the keys)
    that the batch touches are read and rewritten."""
    table = Table(batch.sparkSession, root)
    if table.has(name):
        return
    batch = batch.persist()
    try:
        parts = _touched(batch, part_by)
        if not parts:
            return
        fresh = batch.dropDuplicates(keys)
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
        kept = table.read(batch.schema, parts).alias("o").join(fresh.alias("n"), same, "left_anti")
        table.commit(_write(kept.unionByName(fresh), table, parts, part_by), name)
    finally:
        batch.unpersist()


def add_rollup(summary: DataFrame, root: str, unit: str, name: str) -> None:
    """X1, incremental: add a batch of 15-minute summaries to the exact partial
    states of their periods (:func:`history.rollup_states`). Parts are periods:
    a batch reads and rewrites the few rows of the periods it touches, never the
    history. Each window must come once, as append mode emits it."""
    table = Table(summary.sparkSession, root)
    if table.has(name):
        return
    states = history.rollup_states(summary, unit).persist()
    try:
        parts = _touched(states, "period_start")
        if parts:
            merged = history.merge_states(table.read(states.schema, parts).unionByName(states))
            table.commit(_write(merged, table, parts, "period_start"), name)
    finally:
        states.unpersist()
