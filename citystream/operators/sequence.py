"""Sequence building blocks that split a hot key across tasks.

A window partitioned by one key sends all of that key's rows to one task.
These helpers partition by (key, time chunk) instead, run the window inside
each chunk, and repair the chunk boundaries with a per-chunk summary table
(one row per key and chunk — small) scanned by key. The result equals the
plain per-key window; only the work split differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_SECONDS = 3600
NULL_TIME_CHUNK = -(2 ** 62)  # rows without event time sort before every chunk


def _sort(order: list[str]) -> list[Column]:
    # Ascending, nulls first: the same total order a struct comparison uses.
    return [F.col(c).asc_nulls_first() for c in order]


def time_chunk(ts: str | Column, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.floor(F.unix_micros(c) / F.lit(chunk_seconds * 1_000_000)),
                      F.lit(NULL_TIME_CHUNK).cast("long"))


def adjacent_rows(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                  chunk_col: str = "_chunk") -> DataFrame:
    """Adds ``prev_<c>`` and ``next_<c>``: c on the previous / next row of the
    same key in ``order`` (column names, ascending, nulls first).
    ``chunk_col`` must be monotone in ``order``."""
    w = Window.partitionBy(*keys, chunk_col).orderBy(*_sort(order))
    local = df.select("*", F.row_number().over(w).alias("_rn"),
                      F.lead(F.lit(True)).over(w).isNull().alias("_is_last"),
                      *[F.lag(c).over(w).alias(f"_lag_{c}") for c in cols],
                      *[F.lead(c).over(w).alias(f"_lead_{c}") for c in cols])
    okey = F.struct(*order)
    edges = (df.groupBy(*keys, chunk_col)
             .agg(F.min_by(F.struct(*cols), okey).alias("_f"), F.max_by(F.struct(*cols), okey).alias("_l")))
    we = Window.partitionBy(*keys).orderBy(chunk_col)
    edges = edges.select(*keys, chunk_col, F.lag("_l").over(we).alias("_pl"),
                         F.lead("_f").over(we).alias("_nf"))
    joined = local.join(edges, [*keys, chunk_col], "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_rn") == 1, F.col(f"_pl.{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
          for c in cols],
        *[F.when(F.col("_is_last"), F.col(f"_nf.{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}")
          for c in cols])


def streak_positions(df: DataFrame, keys: list[str], order: list[str], flag: str,
                     chunk_col: str = "_chunk") -> DataFrame:
    """Flagged rows with ``run_pos``: 1-based position inside the maximal run
    of consecutive flagged rows of the key (gaps-and-islands), chunk-split.

    Inside a chunk a row's position is its index minus the index of the last
    unflagged row. Rows of a run that began in an earlier chunk add a carry:
    the length of the run still open at the end of the previous chunk, derived
    from per-chunk (rows, all-flagged, trailing-run) summaries.
    """
    w = Window.partitionBy(*keys, chunk_col).orderBy(*_sort(order))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (df.withColumn("_idx", F.row_number().over(w))
              .withColumn("_lb", F.max(F.when(~F.col(flag), F.col("_idx"))).over(upto)))
    summary = (rows.groupBy(*keys, chunk_col)
               .agg(F.count("*").alias("_n"), F.max(F.when(~F.col(flag), F.col("_idx"))).alias("_lbc"))
               .withColumn("_all", F.col("_lbc").isNull())
               .withColumn("_trail", F.col("_n") - F.coalesce("_lbc", F.lit(0))))
    ws = Window.partitionBy(*keys).orderBy(chunk_col)
    ws_upto = ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = (summary.withColumn("_cum", F.sum("_n").over(ws_upto))
               .withColumn("_brk", F.last(F.when(~F.col("_all"), F.struct("_trail", "_cum")), True)
                           .over(ws_upto)))
    # Length of the run open at the end of this chunk.
    run_end = F.when(F.col("_brk").isNull(), F.col("_cum")) \
               .otherwise(F.col("_brk._trail") + F.col("_cum") - F.col("_brk._cum"))
    carry = summary.select(*keys, chunk_col,
                           F.coalesce(F.lag(run_end).over(ws), F.lit(0)).alias("_carry"))
    # Rows of a run reaching back to the chunk start (_lb null) add the carry.
    return (rows.where(F.col(flag)).join(carry, [*keys, chunk_col], "left")
            .withColumn("run_pos", F.col("_idx") - F.coalesce("_lb", -F.col("_carry")))
            .drop("_idx", "_lb", "_carry"))
