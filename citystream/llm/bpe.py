"""Byte-level BPE encoding and decoding with given merge ranks.

A text is split by the vocabulary's pattern; each piece is merged on its own.
The merge loop keeps pieces as a linked list of parts, with barriers between
them, and a rank queue: a bucket per merge rank holds the list positions whose
pair has that rank, and a three-level bitmap over the buckets finds the lowest
occupied rank by find-first-set. Entries are never removed early: a popped
position whose pair has changed since is stale and skipped. n bytes of pieces
cost O(n log n) whatever the pieces' lengths, and the queue is empty again
afterwards. An encoder, with the ids of the pieces it has met, lives as long as
the Python worker.

Defined results: a null text is empty: no ids. Texts are encoded whole, with
special tokens' strings as ordinary text. Rows are handled one by one, so
repeated rows, null ids and empty tables need no special case; other columns
of the input are not carried along.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable
from struct import pack

import numpy as np
import regex
from pyspark.sql import DataFrame

from citystream.llm.common import map_rows, worker_store
from citystream.session import prepare

#: Pieces remembered by a worker, and the longest remembered.
CACHE_PIECES, CACHE_CHARS = 300_000, 32
#: Characters whose pieces are held and merged at a time (or one text).
STRETCH = 1 << 19


def with_ranges(pattern: str, below: int = 0x110000) -> str:
    r"""``pattern`` with its ``\p{L}``, ``\p{N}`` and ``\s`` spelled out as
    character ranges (``\s``: the Unicode white space, which leaves out the
    four separators that Python's own class adds). The standard engine looks
    such ranges up in a bitmap, several times faster than a property test.
    The result holds for texts of code points under ``below``."""
    every = "".join(map(chr, (*range(min(below, 0xD800)), *range(0xE000, below))))

    def spelled(name: str) -> str:
        runs = (m[0] for m in regex.finditer(name + "+", every))
        return "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[-1]):08x}" for r in runs)

    out, inside, classes = [], False, {}
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part.startswith("\\p") or part in ("\\s", "\\S"):
            name = r"\p{White_Space}" if part in ("\\s", "\\S") else part
            ranges = classes.get(name) or classes.setdefault(name, spelled(name))
            if part == "\\S" and inside:
                raise ValueError("\\S inside a character class is not supported")
            out.append(ranges if inside else f"[{'^' * (part == chr(92) + 'S')}{ranges}]")
            continue
        inside = part == "[" or inside and part != "]"
        out.append(part)
    return "".join(out)


def spell(pattern: str) -> list[str]:
    """``pattern`` for ASCII texts, for those up to 0xFFFF, where the engine's
    bitmap ends, and for all."""
    return [with_ranges(pattern, below) for below in (0x80, 0x10000, 0x110000)]


class RankQueue:
    """Positions by merge rank, lowest rank and then leftmost position first.

    ``low`` holds a bit per rank (256 ranks a word), the search's ``top`` a bit
    per occupied word. :meth:`Encoder.merge` works on the fields directly,
    since a call per push or pop would double the cost of a short piece."""

    def __init__(self, n_ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(n_ranks)]
        self.low = [0] * ((n_ranks >> 8) + 1)


class Encoder:
    """Encodes and decodes with ``ranks``: token bytes -> id, which is also the merge rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, spelled: list[str] | None = None):
        if any(bytes((b,)) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.queue = RankQueue(len(self.tokens))
        #: Two tokens' ids, the first one in the higher bits, -> the token of both.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.byte_ids = np.array([ranks[bytes((b,))] for b in range(256)], np.int64)
        #: The same for any two bytes; -1 for none.
        self.byte_pairs = np.array([ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], np.int64)
        self.splits = [re.compile(p).findall for p in spelled or spell(pattern)]
        self.known: dict[str, bytes] = {}  # packed ids of pieces met

    def split(self, text: str) -> list[str]:
        wide = 0 if text.isascii() else 1 if len(text.encode("utf-16-le")) == 2 * len(text) else 2
        return self.splits[wide](text)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of every piece. All pieces share one linked list, with a
        barrier after each, and one queue. A rank's bucket is emptied in one go,
        from left to right, unless a merge makes a pair of lower rank, which
        comes first in its piece."""
        if not pieces:
            return []
        data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        barriers = np.cumsum([len(p) + 1 for p in pieces]) - 1
        n = len(data)
        start = self.byte_ids[data]
        start[barriers] = -1
        rank_at = np.append(self.byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]], -1)
        rank_at[barriers] = rank_at[barriers - 1] = -1
        ids, pair = start.tolist(), rank_at.tolist()  # pair: rank of the part at a position with the part after it
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets, low, top = self.queue.buckets, self.queue.low, 0
        at = np.flatnonzero(rank_at >= 0)
        at = at[np.argsort(rank_at[at], kind="stable")]
        for group in np.split(at, np.flatnonzero(np.diff(rank_at[at])) + 1) if len(at) else ():
            r = int(rank_at[group[0]])
            buckets[r] = group.tolist()
            low[r >> 8] |= 1 << (r & 255)
            top |= 1 << (r >> 8)
        get = self.pairs.get
        while top:
            i = (top & -top).bit_length() - 1
            word = low[i]
            bit = word & -word
            rank = i << 8 | bit.bit_length() - 1
            bucket, buckets[rank] = buckets[rank], []
            low[i] = word = word ^ bit
            if not word:
                top &= top - 1
            bucket.sort()
            for j, p in enumerate(bucket):
                if pair[p] != rank:
                    continue  # stale: one of its parts has been merged since
                middle = after[p]
                after[p] = stop = after[middle]
                before[stop] = p
                ids[p], ids[middle], pair[middle] = rank, -2, -1
                # A barrier's -1 makes a key that no pair has.
                pair[p] = r = get(rank << 32 | ids[stop], -1)
                lower = False
                if r >= 0:
                    if not buckets[r]:
                        low[r >> 8] |= 1 << (r & 255)
                        top |= 1 << (r >> 8)
                    buckets[r].append(p)
                    lower = r < rank
                left = before[p]
                pair[left] = r = get(ids[left] << 32 | rank, -1)
                if r >= 0:
                    if not buckets[r]:
                        low[r >> 8] |= 1 << (r & 255)
                        top |= 1 << (r >> 8)
                    buckets[r].append(left)
                    lower = lower or r < rank
                if lower and j + 1 < len(bucket):
                    buckets[rank] = bucket[j + 1:]
                    low[i] |= bit
                    top |= 1 << i
                    break
        found = np.array(ids, np.int64)
        kept = found >= 0
        packed = found[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept)[barriers] * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        made, longer = {}, []
        for p in pieces:
            whole = self.ranks.get(p.encode())
            if whole is None:
                longer.append(p)
            else:
                made[p] = pack("<I", whole)
        made.update(zip(longer, self.merge([p.encode() for p in longer])))
        return made

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        known = self.known
        met = set().union(*split)
        made = self._learn(met.difference(known))
        known.update(made)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for p in made:
            if len(p) > CACHE_CHARS:
                del known[p]
        if len(known) > CACHE_PIECES:
            self.known = {p: known[p] for p in met if p in known}
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        held: list[str] = []
        chars = 0
        for text in texts:
            held.append(text or "")
            chars += len(held[-1])
            if chars >= STRETCH:
                out += self._encode(held)
                held, chars = [], 0
        return out + self._encode(held)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def parse_ranks(lines: list[bytes]) -> dict[bytes, int]:
    """Vocabulary lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file, read where the job is submitted (a few MB)."""
    with open(path, "rb") as f:
        return parse_ranks(f.read().splitlines())


def _each(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, value_col: str, rows: Callable, schema: str) -> DataFrame:
    """``rows(encoder, values) -> columns`` over every batch."""
    # A vocabulary holds some MB, whatever the corpus.
    shared = prepare(df.sparkSession).sparkContext.broadcast((ranks, pattern, spell(pattern)))
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    def make():
        kept = worker_store("byte-level encoders")
        encoder = kept.get(key) or kept.setdefault(key, Encoder(*shared.value))
        return lambda values: rows(encoder, values)

    return map_rows(df, [id_col], value_col, make, schema)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text."""
    return _each(df, ranks, pattern, id_col, text_col,
                 lambda e, texts: {"ids": [np.frombuffer(x, "<i4") for x in e.encode_all(texts)]}, "ids array<int>")


def decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) of every ids array; null counts as empty."""
    return _each(df, ranks, pattern, id_col, ids_col,
                 lambda e, lists: {"decoded": [e.decode(np.array(x or (), "<u4").tobytes()) for x in lists]}, "decoded binary")


def round_trip_digests(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its ids decoded again."""

    def rows(e: Encoder, texts: list[str | None]) -> dict:
        out = []
        for ids in e.encode_all(texts):
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(e.decode(ids)).hexdigest()))
        return dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), zip(*out) if out else ((), (), ())))

    return _each(df, ranks, pattern, id_col, text_col, rows, "n_tokens long, ids_sha256 string, decoded_sha256 string")
