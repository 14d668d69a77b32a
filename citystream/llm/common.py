"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.session import checkpoint_root, prepare

#: A lookup side is broadcast only when counted at or below so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 1 << 25

#: Rows of an Arrow batch of texts.
TEXT_ROWS = 2000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that what one task
    has learned serves the worker's later ones. (The package travels by value:
    its own module variables are new in every task.)"""
    own = sys.modules.setdefault("_citystream_worker", types.ModuleType("_citystream_worker"))
    return own.__dict__.setdefault(name, {})


def prepare_texts(spark: SparkSession) -> SparkSession:
    """``spark`` with Arrow batches of at most ``TEXT_ROWS`` rows: texts are
    long, and a batch is held by the executor and by the worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))
    return prepare(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_texts(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(prepare(df.sparkSession))
    return df.checkpoint(eager=True)


def small(df: DataFrame, most: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` was counted to hold at most ``most`` rows, and ``size``
    bytes in its columns of no fixed width."""
    wide = [F.octet_length(c if t in ("string", "binary") else F.to_json(F.struct(c)))
            for c, t in df.dtypes if t in ("string", "binary") or t.startswith(("array", "struct", "map"))]
    held = F.sum(sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(0).cast("long")))
    n, n_bytes = df.limit(most + 1).agg(F.count("*"), held).first()
    return n <= most and (n_bytes or 0) <= size


def bounded(df: DataFrame, most: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it was counted small; otherwise
    :func:`shuffled`."""
    return F.broadcast(df) if small(df, most, size) else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` with a hint that joins with it go by shuffle, whatever its size
    seems to be: rows that an explode or a Python function makes are sized by
    their width alone, as if they were as many as before."""
    return df.hint("merge")


def ascii_lower(text):
    """Lower-case A-Z only. ``lower`` does just that on pure ASCII and is much
    faster than ``translate``, which serves the texts with other characters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
          "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def sliced(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of few rows, so that few texts are Python objects at a time."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def map_rows(df: DataFrame, keep: list[str], value_col: str, make: Callable[[], Callable], schema: str) -> DataFrame:
    """The ``keep`` columns of ``df`` untouched, then the columns of ``schema``
    ("name type, ..."): ``make()`` runs once per task and gives a function from
    a list of values to a dict of columns. Batches go through Arrow; ids never
    pass pandas, which would round large ones in columns with nulls."""
    prepare_texts(df.sparkSession)
    fields = [c.split() for c in schema.split(", ")]
    types = {name: ARROW[kind] for name, kind in fields}
    given = ", ".join(f"_{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = make()
        for batch in chain.from_iterable(map(sliced, batches)):
            made = rows(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *(pa.array(made[n], t) for n, t in types.items())],
                names=[*(f"_{i}" for i in range(len(keep))), *types])

    rows = df.select(*(df[c].alias(f"_{i}") for i, c in enumerate(keep)), df[value_col].alias("_value"))
    return rows.mapInArrow(work, f"{given}, {schema}").toDF(*keep, *types)
