"""Exact top-k inner-product search by ball trees, branch and bound per shard.

The vectors are dealt into shards of at most about ``SHARD`` rows; a task builds
a ball tree over each shard it gets and the queries stream past it in batches,
so memory is bounded by a shard, never by the number of queries. A node's upper
bound for a query q is q . centre + |q| * radius. Nodes are visited in order of
their bound until it falls below the current kth score.

The kth score is shared between shards by two passes: a query first searches
one shard; the kth score found there is its threshold in all others, which
return only what reaches it. Neither pass is approximate.

Components become floor(1024 * x), x as a double, and scores are exact
integers: in doubles while every sum stays under 2^53, else as Python integers.
A score that no long can hold raises an error.

Defined results: vectors that are null or hold a null or a non-finite component
take no part, nor do rows without an id. Only vectors of one length are
compared. Rows that share the query's id are its own and no candidates; other
repeated rows are candidates of their own. A repeated query is answered once,
by the row with the smallest vector. Equal scores go to the smaller id. An empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.llm.common import cut
from citystream.session import prepare

SCALE, SHARD, LEAF = 1024, 1 << 17, 128


class BallTree:
    """Nodes in arrays: centre, radius, row range, children (-1: a leaf)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.order = np.arange(len(ids))
        points = vectors.astype(np.float64)
        centres, radii, self.nodes = [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            at, own = len(self.nodes), points[self.order[lo:hi]]
            centre = own.mean(axis=0)
            centres.append(centre)
            radii.append(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            self.nodes.append([lo, hi, -1, -1])
            if parent >= 0:
                self.nodes[parent][2 + side] = at
            if hi - lo > LEAF and radii[-1] > 0:
                # Cut in half across the direction between two far points.
                a = own[((own - centre) ** 2).sum(axis=1).argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                along, half = own @ (b - a), (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(along, half)]
                todo += [(lo, lo + half, at, 0), (lo + half, hi, at, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.largest = float(np.abs(points).max(initial=0))
        self.exact = points[self.order]

    def scores(self, query: np.ndarray, lo: int, hi: int) -> list[int]:
        if self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(1, len(query)) < 2 ** 53:
            return (self.exact[lo:hi] @ query.astype(np.float64)).astype(np.int64)
        whole = [int(x) for x in query]
        return np.array([sum(a * int(b) for a, b in zip(whole, row)) for row in self.vectors[lo:hi]], object)

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best, only scores of at least ``least`` if given."""
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, at = heapq.heappop(heap)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -bound < floor:
                break
            lo, hi, left, right = self.nodes[at]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            scores = self.scores(query, lo, hi)
            fit = self.ids[lo:hi] != query_id
            if floor is not None:
                fit &= (scores >= floor).astype(bool)
            for score, own in zip(scores[fit].tolist(), self.ids[lo:hi][fit].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -own))
                elif (score, -own) > best[0]:
                    heapq.heapreplace(best, (score, -own))
        return [(s, -i) for s, i in best]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of all nodes for every query, rounded up well beyond the error of doubles."""
        q = queries.astype(np.float64)
        norms = np.sqrt((q * q).sum(axis=1))[:, None]
        size = norms * (np.sqrt((self.centres ** 2).sum(axis=1)) + self.radii)
        return q @ self.centres.T + norms * self.radii + 1e-9 * size + 1e-6


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """Integer vectors; objects where a component is beyond exact doubles' use."""
    out = []
    for x in column:
        v = np.floor(SCALE * np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64))
        out.append(v.astype(np.int64) if np.abs(v).max(initial=0) < 2 ** 62 else np.array([int(c) for c in v], object))
    return out


def _stack(vectors: list[np.ndarray]) -> np.ndarray:
    kind = object if any(v.dtype == object for v in vectors) else np.int64
    return np.array([v.astype(kind) for v in vectors], kind).reshape(len(vectors), -1)


def _search(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) from rows (dim, shard, is_query, id, vector,
    least) that lie by shard, a shard's candidates before its queries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, tree = None, [], [], None
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            dims, shards, kinds, own, _, least = (c.to_pylist() if i != 4 else None for i, c in enumerate(batch.columns))
            i = 0
            while i < len(own):
                j = i
                while j < len(own) and (dims[j], shards[j], kinds[j]) == (dims[i], shards[i], kinds[i]):
                    j += 1
                if (dims[i], shards[i]) != key:
                    key, ids, vectors, tree = (dims[i], shards[i]), [], [], None
                part = _vectors(batch.column(4).slice(i, j - i))
                if not kinds[i]:
                    ids += own[i:j]
                    vectors += part
                elif ids:
                    tree = tree or BallTree(np.array(ids, np.int64), _stack(vectors))
                    vectors = []
                    for at in range(0, len(part), 256):
                        block = _stack(part[at:at + 256])
                        for row, (query, bounds) in enumerate(zip(block, tree.bounds(block)), i + at):
                            found += [(own[row], v, s) for s, v in tree.search(own[row], query, bounds, k, least[row])]
                i = j
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)],
                                             names=["query_id", "vec_id", "score"])

    order = ["dim", "shard", "is_query", "id"]
    return (rows.repartition("dim", "shard").sortWithinPartitions(*order)
            .select(*order[:3], "id", "vector", "least").mapInArrow(work, "query_id long, vec_id long, score long"))


def top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row that ``is_query`` holds for."""
    spark = prepare(df.sparkSession)
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<double>").alias("vector"),
                      F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where("id IS NOT NULL AND vector IS NOT NULL").where(~odd).withColumn("dim", F.size("vector")))
    # As many shards as their size asks for, or as keep the cores busy with trees worth building.
    n = rows.count()
    shards = max(1, -(-n // shard_rows), min(spark.sparkContext.defaultParallelism, n // 2048))
    shard = F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")
    candidates = rows.select("dim", shard.alias("shard"), F.lit(False).alias("is_query"), "id", "vector",
                             F.lit(None).cast("long").alias("least"))
    queries = rows.where("asks").groupBy("dim", "id").agg(F.min("vector").alias("vector"))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    asked = queries.select("dim", home.alias("shard"), F.lit(True).alias("is_query"), "id", "vector",
                           F.lit(None).cast("long").alias("least"))
    first = cut(_search(candidates.unionByName(asked), k))
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (first.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") == k)
           .select(F.col("query_id").alias("id"), F.col("score").alias("least")))
    others = F.expr(f"filter(sequence(0, {shards - 1}), s -> s <> home)")
    again = (queries.withColumn("home", home).join(kth, "id", "left")
             .select("dim", F.explode(others).alias("shard"), F.lit(True).alias("is_query"), "id", "vector", "least"))
    second = _search(candidates.unionByName(again), k)
    return (first.unionByName(second).withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
