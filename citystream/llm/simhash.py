"""SimHash near-duplicates by anchor-point covering.

Fingerprints: the words of a text (A-Z lower-cased) in runs of ``shingle``
words; a bit is set if it is set in over half of the shingles' XXH64 hashes.

Linking is exact for every pair at ``max_bits`` or fewer differing bits:

1. The 64 bits are cut into ``max_bits // 2 + 1`` parts, so that a linked pair
   differs in at most one bit within some part.
2. In each part the anchors are the code words of a perfect Hamming code, a
   covering code of radius 1: a fingerprint's *home* is the anchor at most one
   bit away from it.
3. Each fingerprint is replicated to all anchors within the covering radius
   plus the threshold, 1 + 1 bits: at most 16 a part for the [31,26] code of
   the default. A linked pair meets at either one's home.
4. At every anchor the homes are compared with all fingerprints there.

Only distinct fingerprints are linked, so exact copies cost nothing. An anchor
with more than ``BLOCK`` rows is split: its homes and its replicas are dealt
into blocks and every pair of blocks is a group of its own, so no group holds
more than about two blocks and none is dropped. A group gives the links of a
spanning forest, never all its pairs; their components are those of all links.

Defined results: null and word-less texts have fingerprint zero and are linked
like any other. Null ids are kept as rows; they never name a component, which
is null if it has no other id. Repeated rows come back as often as they come
in. An empty table gives an empty result. Other columns are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.llm.common import cut, map_rows, shuffled
from citystream.llm.components import components

SEED = 42
#: Rows of an anchor that are compared in one group; shingles hashed at once.
BLOCK, CHUNK = 4096, 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = text.encode().lower().split() if text is not None else []  # bytes: ASCII case and white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[len(words) - n:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], stops[i:i + CHUNK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp): ``fp`` holds the 64 bits as a signed long."""
    def make():
        return lambda texts: {"fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    return map_rows(df, [id_col], text_col, make, "fp long")


class HammingCode:
    """The perfect Hamming code of length 2^r - 1 on the low bits of a part."""

    def __init__(self, width: int):
        self.r = (width + 1).bit_length() - 1
        self.length = 2 ** self.r - 1
        positions = np.arange(1, self.length + 1)
        bits = np.uint64(1) << np.arange(self.length, dtype=np.uint64)
        self.checks = [np.bitwise_or.reduce(bits[(positions >> j) & 1 == 1]) for j in range(self.r)]
        # flips[s]: masks that lead from a word of syndrome s to a code word at
        # most two bits away: the single error, then the pairs of positions
        # whose numbers combine to s.
        self.flips = np.zeros((2 ** self.r, 1 + (self.length - 1) // 2), np.uint64)
        for s in range(1, 2 ** self.r):
            pairs = [(a, a ^ s) for a in range(1, self.length + 1) if a < a ^ s]
            self.flips[s] = [bits[s - 1], *(bits[a - 1] | bits[b - 1] for a, b in pairs)]

    def anchors(self, words: np.ndarray) -> np.ndarray:
        """A row per word: its home anchor, then the other anchors within two bits (a code word has only itself)."""
        low = words & np.uint64((1 << self.length) - 1)
        syndrome = np.zeros(len(low), np.int64)
        for j, mask in enumerate(self.checks):
            syndrome |= (np.bitwise_count(low & mask).astype(np.int64) & 1) << j
        return low[:, None] ^ self.flips[syndrome]


def anchor_rows(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(part, anchor, fp, home): every fingerprint at each anchor in reach."""
    parts = max_bits // 2 + 1
    width = 64 // parts

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = HammingCode(min(width, 63))
        for pdf in batches:
            for i in range(0, len(pdf), 4096):
                fp = pdf["fp"].to_numpy()[i:i + 4096]
                for part in range(parts):
                    at = code.anchors(fp.view(np.uint64) >> np.uint64(part * width))
                    home = np.zeros(at.shape, bool)
                    home[:, 0] = True
                    keep = home | (at != at[:, :1])
                    yield pd.DataFrame({"part": part, "anchor": at[keep].view(np.int64),
                                        "fp": np.repeat(fp, keep.sum(axis=1)), "home": home[keep]})

    return distinct.mapInPandas(work, "part int, anchor long, fp long, home boolean")


def forest(homes: np.ndarray, others: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (root, member) that join what the links between ``homes`` and
    ``homes`` or ``others`` join: a search from every home not yet reached, in
    which each home is compared once with the fingerprints this search hasn't
    reached. The others are never searched from, so every search meets them anew."""
    is_home, out = set(homes.tolist()), []
    rest = np.unique(np.concatenate([homes, others]))
    for start in homes.tolist():
        if start not in is_home:
            continue
        is_home.discard(start)
        rest = rest[rest != start]
        queue, left, reached = [start], rest, []
        while queue and len(left):
            near = np.bitwise_count(left.view(np.uint64) ^ np.array([queue.pop()]).view(np.uint64)[0]) <= max_bits
            if near.any():
                found, left = left[near].tolist(), left[~near]
                out += [(start, x) for x in found]
                again = [x for x in found if x in is_home]
                queue += again
                reached += again
                is_home.difference_update(again)
        if reached:
            rest = rest[~np.isin(rest, reached)]
    return out


def links(distinct: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``max_bits``."""
    rows = anchor_rows(distinct, max_bits)
    at = ["part", "anchor"]
    # Anchors that hold a home and another fingerprint, with their number of blocks.
    used = (rows.groupBy(*at).agg(F.count("*").alias("n"), F.max("home").alias("any_home"))
            .where("any_home AND n > 1")
            .select(*at, F.ceil(F.col("n") / F.lit(block)).cast("int").alias("k")))
    # A home meets every block of replicas, a replica every block of homes; a
    # home of a split anchor is also dealt as a replica, for the other homes.
    spots = F.expr("""
        concat(if(home, transform(sequence(0, k - 1), j -> struct(own AS i, j, true AS as_home)), array()),
               if(k > 1 OR NOT home, transform(sequence(0, k - 1), i -> struct(i, own AS j, false AS as_home)), array()))""")
    dealt = (rows.join(shuffled(used), at)
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
             .select(*at, "fp", F.inline(spots).alias("i", "j", "as_home")))
    groups = (dealt.groupBy(*at, "i", "j")
              .agg(F.collect_list(F.when(F.col("as_home"), F.col("fp"))).alias("homes"),
                   F.collect_list(F.when(~F.col("as_home"), F.col("fp"))).alias("others"))
              .where(F.size("homes") > 0).where(F.size("homes") + F.size("others") > 1)
              .select("homes", "others"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [x for h, o in zip(pdf["homes"], pdf["others"])
                     for x in forest(np.asarray(h, np.int64), np.asarray(o, np.int64), max_bits)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return groups.mapInPandas(work, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) for every row; see the module's text."""
    if not 0 <= max_bits <= 10:
        raise ValueError("max_bits must be from 0 to 10: beyond that a part's code is too short to tell texts apart")
    docs = cut(fingerprints(df, id_col, text_col, shingle))
    distinct = docs.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return (docs.join(by_fp, "fp", "left")
            .select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
