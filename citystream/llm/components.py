"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm.common import cut


def _state(edges: DataFrame):
    """One row that tells whether a round changed the edges."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _hook(edges: DataFrame, to_smaller: bool) -> DataFrame:
    """Every node hands its smallest neighbour to its other neighbours: to the
    larger ones (large star) or the smaller ones and itself (small star). The
    minimum is an aggregate joined back, so a node with very many neighbours
    is a skewed join side, which Spark splits, not a gathered group."""
    if to_smaller:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hooked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return hooked.union(least.select("u", F.col("m").alias("v"))).distinct()
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, not null): the
    root is the smallest node of the component. Each round's edges go to a
    reliable checkpoint; the number of rounds is logarithmic in the number of
    nodes. A self-loop gives a node of its own only if it has another edge."""
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _state(e)
    while seen[0]:
        e = cut(_hook(_hook(e, False), True))
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
