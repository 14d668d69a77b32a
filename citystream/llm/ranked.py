"""Ranked lexical search by K2-treaps over the term-document grid.

The grid has a row for every term of the items and a column for every document;
a point's value is its impact, the term's share of a score before the weight.
A shard of documents is a K2-treap: a quadtree whose empty quadrants aren't
stored and whose cells hold the largest impact below them. An item starts with
one document range, the whole shard, and its terms' paths at the root. A range
splits in two, every term's path steps into the quadrant of its row, and the
weighted maxima of the cells reached bound the scores in the half. Ranges with
the highest bounds are split first, many at a time; those below the k-th score
found are given up.

The documents are read twice in a compact form: once to count terms and write
each document's counts of the items' terms as a table in the shared folder,
then, with the corpus statistics known, to build and search the treaps. No
posting is shuffled. What is shuffled are term counts and, for every shard of
``SHARD`` documents and item, at most k scores.

Items are searched in blocks of at most ``BLOCK`` bytes of text, so what goes
to the tasks is bounded however many items there are.

Defined results: terms are counted over whole texts. A null or term-less
document isn't counted or found; a null or term-less item finds nothing.
Repeated rows and rows without an id are documents of their own; equal scores
go by ascending id, null ids last, and equal ids in no defined order. An item
present in several rows has the terms of them all; rows without an item id are
one item. Empty tables give an empty result. Other columns are not carried along.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citystream.llm.common import sliced
from citystream.session import prepare, scratch_path

#: Documents of a treap; bytes of item texts searched at a time.
SHARD, BLOCK = 1 << 14, 1 << 22
#: Ranges split in a search's first sweep; every further sweep takes twice as many.
WIDTH = 128

# Bytes of a term as they are, A-Z lower-cased, everything else a blank.
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_BITS_BELOW = np.array([[bin(mask & ((1 << q) - 1)).count("1") for q in range(4)] for mask in range(16)], np.int32)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM).split() if text else []


def _spread(x: np.ndarray) -> np.ndarray:
    """Every bit of ``x`` (at most 32) moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """A compressed quadtree of points (row, column, impact), one per place.

    A level is three arrays over its stored cells, in Morton order: the mask of
    stored quadrants, the first one's place in the next level, and the largest
    impact. A last, empty cell stands for all that are not stored."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impact: np.ndarray, n_rows: int, n_cols: int):
        self.height = max(n_rows - 1, n_cols - 1, 1).bit_length()
        order = np.argsort(code := _spread(rows) << np.uint64(1) | _spread(cols), kind="stable")
        code, best = code[order], impact[order].astype(np.int64)
        self.levels = [(None, None, np.append(best, 0))]
        for _ in range(self.height):
            start = np.flatnonzero(np.diff(code >> np.uint64(2), prepend=np.uint64(1 << 63)))
            quadrant = np.left_shift(1, (code & np.uint64(3)).astype(np.uint8), dtype=np.uint8)
            mask = np.bitwise_or.reduceat(quadrant, start) if len(start) else quadrant
            best = np.maximum.reduceat(best, start) if len(start) else best
            code = code[start] >> np.uint64(2)
            self.levels.append((np.append(mask, np.uint8(0)), np.append(start, 0).astype(np.int32), np.append(best, 0)))
        self.levels.reverse()

    def step(self, level: int, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The cells of the next level in ``quadrant`` of ``cells``."""
        mask, first, _ = self.levels[level]
        own = mask[cells]
        there = first[cells] + _BITS_BELOW[own, quadrant]
        return np.where(own >> quadrant & 1, there, len(self.levels[level + 1][2]) - 1)

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the k highest positive scores and all that equal the k-th."""
        h = self.height
        nothing = np.empty(0, np.int64)
        cells = np.zeros((1, len(rows)), np.int32)
        # For every level the open ranges: bound, column prefix, a cell per row.
        pool = [(self.levels[0][2][cells] @ weights, np.zeros(1, np.int64), cells)] + [
            (nothing, nothing, np.empty((0, len(rows)), np.int32)) for _ in range(h)]
        least, width = 1, WIDTH
        while True:
            bounds = np.concatenate([p[0] for p in pool[:h]])
            bounds = bounds[bounds >= least]
            if not len(bounds):
                return pool[h][1], pool[h][0]
            # One sweep splits every range whose bound is among the highest, and its parts that still are.
            bar = max(least, int(np.partition(bounds, -width)[-width])) if len(bounds) > width else least
            for level in range(h):
                bound, column, cells = pool[level]
                now = bound >= bar
                if not now.any():
                    continue
                later = (bound >= least) & ~now
                pool[level] = bound[later], column[later], cells[later]
                column, cells = column[now], cells[now]
                half = (rows >> (h - 1 - level) & 1) * 2
                made = [(b, self.step(level, cells, half + b)) for b in (0, 1)]
                best = self.levels[level + 1][2]
                parts = [(best[c] @ weights, column * 2 + b, c) for b, c in made]
                old = pool[level + 1]
                new = [np.concatenate([old[i], *(p[i][p[0] >= least] for p in parts)]) for i in range(3)]
                if level + 1 == h and len(new[0]) > k:
                    least = max(least, int(np.partition(new[0], -k)[-k]))
                    new = [x[new[0] >= least] for x in new]
                pool[level + 1] = tuple(new)
            width *= 2


def _counts(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, times): for every document with a term its length in
    terms, the numbers of its terms in ``vocabulary`` and how often they occur."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in chain.from_iterable(map(sliced, batches)):
            at, sizes, ends, terms, times = [], [], [0], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = terms_of(text)
                if not found:
                    continue
                at.append(i)
                sizes.append(len(found))
                times_of = Counter(found)
                for term in times_of.keys() & known.keys():
                    terms.append(known[term])
                    times.append(times_of[term])
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()), *lists],
                                             names=["id", "n", "terms", "times"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n long, terms array<int>, times array<int>")


def _search(counts: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, shard: int) -> DataFrame:
    """(item, id, score): the k best of every treap."""
    shared = counts.sparkSession.sparkContext.broadcast((items, weights))

    def best(table: pa.Table) -> pa.RecordBatch:
        own_items, w = shared.value
        lists = [table.column(c).combine_chunks() for c in ("terms", "times")]
        lengths = np.diff(lists[0].offsets.to_numpy())
        rows, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        m = 100 - 50 + 50 * table.column("n").to_numpy().astype(np.int64) * n_docs // n_terms
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, lengths))
        treap = Treap(rows, np.repeat(np.arange(len(lengths)), lengths), impact, len(w), len(lengths))
        there = np.zeros(len(w), bool)
        there[rows] = True
        ids = table.column("id").combine_chunks()
        item, column, score = [], [], []
        for i, own in enumerate(own_items):
            own = own[there[own]]
            if len(own):
                c, s = treap.search(own, w[own], k)
                if len(c) > k:  # some equal the k-th
                    found = pa.table({"score": s, "id": ids.take(pa.array(c))})
                    first = pc.sort_indices(found, [("score", "descending"), ("id", "ascending")])[:k].to_numpy()
                    c, s = c[first], s[first]
                item.append(np.full(len(c), i, np.int32))
                column.append(c)
                score.append(s)
        joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (item, column, score)]
        return pa.RecordBatch.from_arrays([pa.array(joined[0].astype(np.int32)), ids.take(pa.array(joined[1])),
                                           pa.array(joined[2].astype(np.int64))], names=["item", "id", "score"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= shard:
                yield best(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield best(pa.Table.from_batches(held))

    kind = counts.schema["id"].dataType.simpleString()
    return counts.mapInArrow(work, f"item int, id {kind}, score long")


def _rank_block(docs: DataFrame, rows: list, k: int, id_col: str, text_col: str, item_type: T.DataType, shard: int) -> DataFrame | None:
    spark = docs.sparkSession
    wanted: dict[object, dict[bytes, None]] = {}
    for item_id, text in rows:
        wanted.setdefault(item_id, {}).update(dict.fromkeys(terms_of(text and bytes(text))))
    vocabulary: dict[bytes, int] = {}
    for found in wanted.values():
        for term in found:
            vocabulary.setdefault(term, len(vocabulary))
    if not vocabulary:
        return None
    path = scratch_path(spark, "term-counts")
    _counts(docs, id_col, text_col, vocabulary).write.parquet(path)
    counts = spark.read.parquet(path)
    n_docs, n_terms = counts.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    # At most a row for each term of the block.
    holding = dict(counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    items = [np.array([vocabulary[t] for t in found], np.int64) for found in wanted.values()]
    names = spark.createDataFrame([(i, name) for i, name in enumerate(wanted)],
                                  T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = _search(counts, items, weights, n_docs, n_terms, k, shard).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of every item."""
    spark = prepare(docs.sparkSession)
    asked = items.select(items[item_id_col].alias("item_id"), items[item_text_col].cast("binary").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block)
    item_type = items.schema[item_id_col].dataType
    out = None
    for b in range(blocks):
        # About ``block`` bytes of text.
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        found = _rank_block(docs, rows, k, id_col, text_col, item_type, shard)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is not None:
        return out
    kind = docs.schema[id_col].dataType
    return spark.createDataFrame([], T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                                                   T.StructField("doc_id", kind), T.StructField("score", T.LongType())]))
