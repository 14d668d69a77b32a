"""Join helpers: size-checked broadcast of lookup tables, last-wins tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables are narrow (a handful of short strings); 200k rows stay far
# below the broadcast memory budget of an executor.
BROADCAST_MAX_ROWS = 200_000


def broadcast_if_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only after proving the side has at most ``max_rows``.

    The probe reads at most ``max_rows + 1`` rows. Beyond the bound the
    DataFrame is returned unhinted and Spark plans a shuffle join instead
    (AQE may still demote it to broadcast once real sizes are known).
    """
    if small.isStreaming:
        return small
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Table semantics (S7): one row per key, the row with the greatest
    ``order_col`` wins (later duplicates overwrite earlier ones).

    ``max_by`` over a struct is an algebraic aggregate: partial aggregation
    before the shuffle, so a hot key never gathers its rows in one task.
    """
    value_cols = [c for c in df.columns if c not in (key, order_col)]
    agg = df.groupBy(key).agg(
        F.max_by(F.struct(*value_cols), F.col(order_col)).alias("_v"))
    return agg.select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])
