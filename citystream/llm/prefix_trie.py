"""A trie of conversations' prefixes, screened by a count-min sketch.

Every turn has a digest (128 bits of the SHA-256 of role and text) and every
prefix the polynomial ``prefix * BASE + turn`` over them, modulo a prime of 127
bits. Prefixes of prefixes compose, so a conversation of any length is worked
on in pieces: turns are sorted by range, every task digests its stretch, and
only the last state of each task (a row per task) passes the driver to be
handed on.

A count-min sketch of all prefixes, merged from the tasks' sketches, is
broadcast (``DEPTH`` rows of at most ``WIDTH`` counters up to two). An estimate of one
proves that a prefix has one conversation: its node is complete and is emitted
where it stands. Only prefixes estimated at two or more are shuffled, and
grouped exactly. A full sketch sends more of them there, never a wrong result.

Sums over a node's subtree are taken along the members' paths: each node is
counted by its smallest member c, whose other nodes on the same path are known
by their depth, so a node's sum is an algebraic aggregate over its members'
rows. No node's members meet in one task but for the digest of the ids that end
at it, which the contract defines as one stream: they pass a task sorted, in
batches.

Defined results: rows without a conversation id are not used; equal turns are
ordered by their digests. Role or text null count as empty. Repeated rows are
turns of their own. An empty table gives no node. Other columns are not carried along.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm.common import bounded, cut
from citystream.session import prepare

#: Modulus and base of prefix digests: a Mersenne prime, and a fixed odd number of 126 bits.
PRIME, BASE = (1 << 127) - 1, 0x2C5A9E3F7B1D4860F3A1C6E8B9D20547
#: Counters of a sketch's row at most, rows, and slices in which sketches are merged.
WIDTH, DEPTH, SLICES = 1 << 22, 4, 64
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "little")


def _bytes(n: int) -> bytes:
    return n.to_bytes(16, "little")


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv, turn, digest, chars): the length goes before the role, so that
    role and text can't trade places."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.substring(F.unhex(F.sha2(said, 256)), 1, 16).alias("digest"), F.char_length(text).cast("long").alias("chars"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, p, before, prefix, chars): the turns in order, numbered from 1,
    with the digests of the prefixes before and up to each of them."""
    parts = max(turns.sparkSession.sparkContext.defaultParallelism, turns.count() >> 20)
    # Kept, so that both readings below see the same rows in the same tasks.
    rows = cut(turns.repartitionByRange(parts, "conv", F.asc_nulls_first("turn"), "digest")
               .sortWithinPartitions("conv", F.asc_nulls_first("turn"), "digest")
               .withColumn("part", F.spark_partition_id()))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task hands on: its part, first and last conversation, and the
        last one's turns here and their digest, as if it began here."""
        part = first = conv = None
        n = state = 0
        for batch in batches:
            for c, digest, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != conv:
                    first = c if first is None else first
                    conv, n, state = c, 0, 0
                n += 1
                state = (state * BASE + _number(digest)) % PRIME
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, first, conv, n, _bytes(state)), types)], names=names)

    names, types = ["part", "first", "conv", "n", "state"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    # A row per task.
    seams = sorted(rows.select("conv", "digest", "part").mapInArrow(ends, "part int, first long, conv long, n long, state binary").collect())
    given: dict[int, tuple[int, int, int]] = {}
    last = None
    for part, first, conv, n, state in seams:
        if last and last[0] == first:
            given[part] = last
        n_before, before = (last[1], last[2]) if last and last[0] == first == conv else (0, 0)
        last = (conv, n_before + n, (before * pow(BASE, n, PRIME) + _number(state)) % PRIME)
    shared = turns.sparkSession.sparkContext.broadcast(given)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, p, state = None, 0, 0
        begun = False
        for batch in batches:
            places, before, prefix = [], [], []
            for c, digest, part in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if not begun:
                    begun = True
                    conv, p, state = shared.value.get(part, (c, 0, 0))
                if c != conv:
                    conv, p, state = c, 0, 0
                p += 1
                places.append(p)
                before.append(_bytes(state))
                state = (state * BASE + _number(digest)) % PRIME
                prefix.append(_bytes(state))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.int64()), pa.array(before, pa.binary()), pa.array(prefix, pa.binary()), batch.column(2)],
                names=["conv", "p", "before", "prefix", "chars"])

    return rows.select("conv", "digest", "chars", "part").mapInArrow(number, "conv long, p long, before binary, prefix binary, chars long")


def crc32_mod(conv: str, n: int):
    return F.pmod(F.crc32(F.col(conv).cast("string").cast("binary")), F.lit(n))


def rebuilt(placed: DataFrame, of: int = 100, variants: int = 6) -> DataFrame:
    """(conv, depth, node, above, chars, size) for every prefix of every rebuilt
    conversation, the empty one included: the first h turns of conversation
    ``conv - conv % of``, then its own after its first h; h = crc32(conv) % variants.
    ``node`` and ``above`` are the digests of the prefix and of the one before;
    ``size`` is the whole rebuilt conversation's number of turns."""
    most = variants - 1
    # At most ``most`` narrow structs a conversation.
    heads = (placed.groupBy("conv").agg(
        F.max("p").alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("p") <= most, F.struct("p", "prefix", "chars")))).alias("first")))
    heads = cut(heads)
    base = bounded(heads.where(F.col("conv") % of == 0).select(F.col("conv").alias("base"), F.col("first").alias("base_first")))
    convs = (heads.withColumn("h", crc32_mod("conv", variants)).withColumn("base", F.col("conv") - F.col("conv") % of)
             .join(base, "base", "left")
             .withColumn("lent", F.expr("if(h > 0, slice(coalesce(base_first, array()), 1, cast(h AS int)), array())"))
             .withColumn("size", F.expr("size(lent) + greatest(n - h, 0)"))
             .withColumn("own", F.expr("if(n > h AND h > 0, first[cast(h AS int) - 1].prefix, NULL)")))
    zero = F.lit(bytes(16))
    lent = convs.select("conv", "size", F.expr(
        "inline(transform(sequence(0, size(lent)), i -> struct(cast(i AS bigint) AS depth, if(i > 0, lent[i - 1].prefix, X'00') AS node, "
        "if(i > 1, lent[i - 2].prefix, X'00') AS above, if(i > 0, lent[i - 1].chars, 0L) AS chars)))"))
    lent = lent.select("conv", "depth", *(F.when(F.octet_length(c) == 1, zero).otherwise(F.col(c)).alias(c) for c in ("node", "above")), "chars", "size")
    # A narrow row per conversation: a long one's rows are a skewed join side, which Spark splits.
    rest = (placed.join(convs.select("conv", "h", "size", "own", F.expr("cast(size(lent) AS bigint)").alias("n_lent"),
                                     F.expr("if(size(lent) > 0, element_at(lent, -1).prefix, NULL)").alias("start")), "conv")
            .where("p > h"))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Own prefixes, moved from their beginning ``own`` to ``start``."""
        powers = [1]
        for batch in batches:
            conv, steps, before, prefix, chars, size, own, start, n_lent = (c.to_pylist() for c in batch.columns)
            shift = [_number(s or b"") - _number(o or b"") for s, o in zip(start, own)]
            node, above = [], []
            for k, d, a, b in zip(steps, shift, before, prefix):
                if k < 4096:
                    while len(powers) <= k:
                        powers.append(powers[-1] * BASE % PRIME)
                    x, y = powers[k - 1], powers[k]
                else:
                    x = pow(BASE, k - 1, PRIME)
                    y = x * BASE % PRIME
                above.append(_bytes((d * x + _number(a)) % PRIME))
                node.append(_bytes((d * y + _number(b)) % PRIME))
            depth = [n + k for n, k in zip(n_lent, steps)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(depth, pa.int64()), pa.array(node, pa.binary()), pa.array(above, pa.binary()), batch.column(4), batch.column(5)],
                names=["conv", "depth", "node", "above", "chars", "size"])

    moved = rest.select("conv", (F.col("p") - F.col("h")).alias("steps"), "before", "prefix", "chars", F.col("size").cast("long").alias("size"), "own", "start", "n_lent") \
        .mapInArrow(move, "conv long, depth long, node binary, above binary, chars long, size long")
    return lent.withColumn("size", F.col("size").cast("long")).unionByName(moved)


class Sketch:
    """Count-min over 16-byte digests; counters stop at two."""

    def __init__(self, width: int, cells: np.ndarray | None = None):
        self.width = width
        self.cells = np.zeros((DEPTH, width), np.uint8) if cells is None else cells.reshape(DEPTH, width)

    def _places(self, digests: pa.Array) -> np.ndarray:
        joined = b"".join(digests.to_pylist())
        return (np.frombuffer(joined, "<u4").reshape(-1, DEPTH) & (self.width - 1)).T

    def add(self, digests: pa.Array) -> None:
        for cells, places in zip(self.cells, self._places(digests)):
            place, times = np.unique(places, return_counts=True)
            cells[place] = np.minimum(cells[place] + times, 2)

    def estimate(self, digests: pa.Array) -> np.ndarray:
        """At least the true count, both counted up to two."""
        return np.min([cells[places] for cells, places in zip(self.cells, self._places(digests))], axis=0)


def sketch(nodes: DataFrame, width: int) -> Sketch:
    """The sketch of all ``nodes``: each task's, merged slice by slice."""
    size = DEPTH * width // SLICES

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            if batch.num_rows:
                made = made or Sketch(width)
                made.add(batch.column(0))
        if made:
            flat = made.cells.reshape(SLICES, size)
            filled = [i for i in range(SLICES) if flat[i].any()]
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array([zlib.compress(flat[i].tobytes(), 1) for i in filled], pa.binary())],
                                             names=["slice", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(zlib.decompress(cells), np.uint8)
                sums[i] = np.minimum(sums[i] + got, 2).astype(np.uint8) if i in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
                                             names=["slice", "cells"])

    merged = nodes.select("node").mapInArrow(own, "slice int, cells binary").repartition(SLICES // 8, "slice").mapInArrow(merge, "slice int, cells binary")
    whole = np.zeros((SLICES, size), np.uint8)
    for i, cells in merged.collect():  # DEPTH * width bytes at most
        whole[i] = np.frombuffer(zlib.decompress(bytes(cells)), np.uint8)
    return Sketch(width, whole)


def screened(paths: DataFrame, counted: Sketch) -> DataFrame:
    """``paths`` with ``single`` and ``above_single``: whether a node, and its
    parent, are proven to have one conversation. The root never is."""
    shared = paths.sparkSession.sparkContext.broadcast((counted.width, counted.cells))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(*shared.value)
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            flags = [(own.estimate(batch.column(c)) < 2) & (depth > least) for c, least in (("node", 0), ("above", 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, flags)], names=[*batch.schema.names, "single", "above_single"])

    kinds = ", ".join(f"{c} {t}" for c, t in paths.dtypes)
    return paths.mapInArrow(work, f"{kinds}, single boolean, above_single boolean")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of (node, depth, conv): every node's ids in order, as one stream."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.binary()), pa.array([at[1]], pa.int64()), pa.array([running.hexdigest()])],
                                              names=["node", "depth", "ends_sha256"])

        for batch in batches:
            done = []
            for node, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (node, depth):
                    if at is not None:
                        done.append((*at, running.hexdigest()))
                    at, running = (node, depth), hashlib.sha256(str(conv).encode())
                else:
                    running.update(b",%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.int64(), pa.string()))],
                                                 names=["node", "depth", "ends_sha256"])
        if at is not None:
            yield row()

    return (ends.select("node", "depth", "conv").repartition("node", "depth").sortWithinPartitions("node", "depth", "conv")
            .mapInArrow(work, "node binary, depth long, ends_sha256 string"))


def trie(turns: DataFrame, of: int = 100, variants: int = 6, width: int = WIDTH) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) for every node of the rebuilt conversations."""
    prepare(turns.sparkSession)
    paths = cut(rebuilt(cut(prefixes(turn_rows(turns))), of, variants))
    n = paths.count()
    while width > 1 << 10 and width >= 8 * n:
        width >>= 1
    marked = cut(screened(paths, sketch(paths, width)))
    singles, shared = marked.where("single"), marked.where("NOT single")
    key = ["node", "depth"]

    grouped = cut(shared.groupBy(*key).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("rep"), F.first("above").alias("above"), F.first("chars").alias("chars"),
        F.first("above_single").alias("above_single")))
    # Children: exact nodes and the tops of tails below them, summed by parent.
    births = (grouped.where("depth > 0").select(F.col("above").alias("node"), (F.col("depth") - 1).alias("depth"))
              .unionAll(singles.where("NOT above_single").select(F.col("above").alias("node"), (F.col("depth") - 1).alias("depth"))))
    nodes = cut(grouped.join(births.groupBy(*key).agg(F.count("*").alias("n_children")), key, "left").fillna(0, ["n_children"]))

    # What each conversation adds to the nodes on its path. Its leaf counts if
    # it is a tail's end or the smallest member of a childless node; the tokens
    # saved at the nodes it is the smallest member of count at each of these for
    # the nodes from there on, at all nodes above for them all.
    own = nodes.select("rep", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    totals = own.groupBy("rep").agg(F.sum("saved").alias("total"))
    leaves = (singles.where("depth = size").select(F.col("conv").alias("rep"))
              .unionAll(nodes.where("n_children = 0").select("rep")).withColumn("leaf", F.lit(1)))
    parts = leaves.join(totals, "rep", "full").select(F.col("rep").alias("conv"), F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("total", F.lit(0)).alias("total"))
    # A conversation's own nodes are the deepest of its path: what lies above one of them is a running sum.
    above = (own.withColumn("above_saved", F.expr("sum(saved) OVER (PARTITION BY rep ORDER BY depth) - saved"))
             .select(F.col("rep").alias("conv"), "depth", "above_saved"))
    members = (shared.select("conv", *key).join(parts, "conv").join(above, ["conv", "depth"], "left")
               .select(*key, "leaf", (F.col("total") - F.coalesce("above_saved", F.lit(0))).alias("saved")))
    sums = members.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    reps = nodes.select(F.col("node").alias("above"), F.col("depth").alias("above_depth"), F.col("rep").alias("parent"))
    exact = (nodes.withColumn("above_depth", F.col("depth") - 1).join(reps, ["above", "above_depth"], "left")
             .join(sums, key, "left").join(ends_digests(shared.where("depth = size")), key, "left")
             .select(F.col("rep").alias("conv_id"), "depth",
                     F.expr("if(depth > 0, if(above_single, rep, parent), NULL)").alias("parent_conv_id"),
                     "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
                     F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
    tops = singles.where("NOT above_single").withColumn("above_depth", F.col("depth") - 1).join(reps, ["above", "above_depth"])
    tails = singles.where("above_single").withColumn("parent", F.col("conv"))
    ended = F.col("depth") == F.col("size")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = [t.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"),
                      F.when(ended, none).otherwise(one).alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
                      F.when(ended, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256")) for t in (tops, tails)]
    return exact.unionByName(alone[0]).unionByName(alone[1])
