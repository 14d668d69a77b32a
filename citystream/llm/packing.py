"""Best-fit packing of tokenized documents by linear grouping.

A document is its ids and an end id; one longer than a sequence is cut into
pieces of a whole sequence and a rest. Whole pieces are sequences of their own.
The rests are dealt evenly into shards of about ``SHARD`` pieces, and each shard
packs its own:

1. Lengths over ``SMALL`` of a sequence are large. In descending order they form
   ``GROUPS`` groups of equal cardinality, each rounded up to its longest.
2. The problem of these few sizes is optimised over configurations (which sizes
   share a sequence, how often) by a linear program; columns are priced by a
   knapsack over the sizes.
3. Every configuration is filled with actual pieces: the longest left of each
   group; for its last place, the longest left that fits, since what the
   rounding saved is room as well. One that still isn't nearly full is undone.
4. The large pieces left over or undone and then the small ones go where they
   leave the least room, longest first.

A shard loses about a sequence against packing everything at once; no task
holds more than a shard's lengths, and no piece's ids are shuffled.

Tokens come from a dictionary of the words met, kept for the life of a worker;
new words are encoded together by the library. Texts for which taking words one
by one isn't proven equal (code points of 0x180 or more, whose normal form or
lower case depends on their neighbours, and special tokens' strings) go to the
library whole.

Defined results: a null text is empty and still has its end id. Repeated rows
and rows without an id are documents of their own. An empty table gives an
empty result. Other columns are not carried along.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citystream.llm.bpe import with_ranges
from citystream.llm.common import cut, sliced, worker_store
from citystream.session import prepare

#: Pieces of a shard; groups of large lengths; the parts of a sequence up to which a length is
#: small, and over which an empty rest undoes a filled configuration.
SHARD, GROUPS, SMALL, LOOSE = 20_000, 48, 1 / 8, 1 / 512
#: Words remembered by a worker, and the longest remembered.
CACHE_WORDS, CACHE_CHARS = 1_000_000, 32
#: Characters whose words are held at a time (or one text).
STRETCH = 1 << 21

# Below 0x180 every code point is its own normal form and has one lower case,
# but for U+0130, whose lower case is two code points.
_WORDWISE = re.compile("[^\x00-įı-ſ]")


class WordEncoder:
    """Ids of whole texts by the vocabulary in ``model`` (the library's JSON)."""

    def __init__(self, model: str):
        self.library = Tokenizer.from_str(model)
        spec = json.loads(model)
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        #: Word by word only where the file has the known steps.
        self.wordwise = normal == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        if self.wordwise:
            self.words = re.compile(with_ranges(split["pattern"]["Regex"], 0x180)).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words, encoded as one text with blanks between them."""
        if not words:
            return {}
        fresh = sorted(words)
        found = self.library.encode(" ".join(fresh), add_special_tokens=False)
        ids, own = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
        ends = np.searchsorted(own, np.arange(len(fresh) + 1))
        if len(own) and own[-1] != len(fresh) - 1:
            raise ValueError("the library split a word")
        return {w: ids[a:b].tobytes() for w, a, b in zip(fresh, ends, ends[1:])}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out, held, chars = [], [], 0
        for text in texts:
            held.append(text)
            chars += len(text or "")
            if chars >= STRETCH:
                out += self._encode(held)
                held, chars = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = [b""] * len(texts)
        split: list[tuple[int, list[str]]] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.wordwise or _WORDWISE.search(text) or any(s in text for s in self.special):
                whole.append(i)
            else:
                split.append((i, self.words(text.lower())))
        known = self.known
        met = set().union(*(ws for _, ws in split))
        made = self._learn(met.difference(known))
        known.update(made)
        for i, ws in split:
            out[i] = b"".join(map(known.__getitem__, ws))
        for w in made:
            if len(w) > CACHE_CHARS:
                del known[w]
        if len(known) > CACHE_WORDS:
            self.known = {w: known[w] for w in met if w in known}
        for i in whole:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out


def pieces(docs: DataFrame, model: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every piece of every document."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    tail = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_store("word encoders")
        key = zlib.crc32(shared.value.encode()), len(shared.value)
        encoder = kept.get(key) or kept.setdefault(key, WordEncoder(shared.value))
        for batch in chain.from_iterable(map(sliced, batches)):
            rows = array("q")
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids += tail
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, size)):
                    rows.extend((i, k, start, min(size, n - start), zlib.crc32(ids[4 * start:4 * (start + size)])))
            at, *columns = np.frombuffer(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(columns[0].astype(np.int32)), *map(pa.array, columns[1:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def grouped(lengths: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, counts, lower bounds) of the ``lengths`` in groups of equal
    cardinality, longest first, each rounded up to its longest; groups of one
    size are one. A length belongs to the group with the least size it fits."""
    falling = np.sort(lengths)[::-1]
    first = np.unique(np.linspace(0, len(falling), min(groups, len(falling)), endpoint=False).astype(int))
    sizes = np.unique(falling[first])[::-1]
    below = np.append(sizes[1:], 0)
    counts = np.array([((lengths <= s) & (lengths > b)).sum() for s, b in zip(sizes, below)])
    return sizes, counts, below


def configurations(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, float]]:
    """(places per size, how often): the least sequences that hold ``counts``
    pieces of ``sizes`` (all over ``SMALL`` of the room), in fractions. A new
    configuration enters while the knapsack finds one worth over a sequence."""
    n = len(sizes)
    most = room // int(sizes.min())
    basis = np.diag((room // sizes).astype(float))
    for _ in range(40 * n):
        often = np.linalg.solve(basis, counts.astype(float))
        price = np.linalg.solve(basis.T, np.ones(n))
        # The best value of at most j places in c tokens, and the last size placed.
        value, last = np.zeros(room + 1), np.full((most + 1, room + 1), -1)
        for j in range(1, most + 1):
            better = value.copy()
            for g, s in enumerate(sizes):
                if price[g] > 0:
                    gain = value[:room + 1 - s] + price[g]
                    now = gain > better[s:] + 1e-12
                    better[s:][now] = gain[now]
                    last[j, s:][now] = g
            value = better
        if value[room] <= 1 + 1e-7:
            break
        column, c = np.zeros(n), room
        for j in range(most, 0, -1):
            if last[j, c] >= 0:
                column[last[j, c]] += 1
                c -= int(sizes[last[j, c]])
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, often / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    often = np.linalg.solve(basis, counts.astype(float))
    return [(basis[:, i].astype(int), float(often[i])) for i in range(n) if often[i] > 1e-9]


def _fitting(there: int, most: int) -> int:
    """The largest number in the bit set ``there`` up to ``most``; -1 if none."""
    return (there & ((2 << most) - 1)).bit_length() - 1


def pack(lengths: np.ndarray, size: int, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every length; sequences are numbered from 0."""
    piles: list[list[int]] = [[] for _ in range(size + 1)]
    for i, n in enumerate(lengths.tolist()):
        piles[n].append(i)
    there = sum(1 << n for n, pile in enumerate(piles) if pile)
    sequence, offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []  # of every sequence
    open_: list[list[int]] = [[] for _ in range(size + 1)]  # sequences by room

    def place(n: int, s: int) -> int:
        nonlocal there
        i = piles[n].pop()
        if not piles[n]:
            there ^= 1 << n
        sequence[i], offset[i] = s, size - room[s]
        room[s] -= n
        return i

    large = lengths[lengths > size * SMALL]
    if len(large):
        sizes, counts, below = grouped(large, groups)
        smallest, taken, loose = int(size * SMALL), [], []
        # Tight configurations first, while every group is full.
        for places, often in sorted(configurations(sizes, counts, size), key=lambda x: -int(x[0] @ sizes)):
            slots = [int(g) for g in np.repeat(np.arange(len(sizes)), places)]
            for _ in range(int(often + 1e-6)):
                if not slots or _fitting(there, int(sizes[slots[0]])) <= max(int(below[slots[0]]), smallest):
                    break  # its longest group is used up
                s = len(room)
                room.append(size)
                for k, g in enumerate(slots):
                    n = _fitting(there, min(room[s], int(sizes[g]) if k < len(slots) - 1 else size))
                    if n > smallest:
                        taken.append(place(n, s))
                if room[s] > size * LOOSE:
                    loose.extend(taken)
                    room.pop()
                taken.clear()
        for i in loose:
            n = int(lengths[i])
            piles[n].append(i)
            there |= 1 << n
    used = 0
    for s, free in enumerate(room):
        open_[free].append(s)
        used |= 1 << free
    while there:
        n = there.bit_length() - 1
        fits = used >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            s = open_[free].pop()
            if not open_[free]:
                used ^= 1 << free
        else:
            s = len(room)
            room.append(size)
        place(n, s)
        open_[room[s]].append(s)
        used |= 1 << room[s]
    return sequence, offset


def pack_documents(docs: DataFrame, model: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", shard: int = SHARD, groups: int = GROUPS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every
    piece of every document and its place in a sequence of ``size`` tokens."""
    cut_pieces = pieces(docs, model, size, end_id, id_col, text_col)
    # Numbered before the checkpoint, so that every later reading sees the same numbers.
    rows = cut(cut_pieces.withColumn("row", F.monotonically_increasing_id()))
    full, rest = rows.where(F.col("length") == size), rows.where(F.col("length") < size)
    shards = max(1, round(rest.count() / shard))
    kind = docs.schema[id_col].dataType.simpleString()

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")  # the same whatever order the rows came in
        number = table.column("shard")[0].as_py()
        sequence, offset = pack(table.column("length").to_numpy(), size, groups)
        return table.drop_columns(["row", "shard"]).append_column("sequence_id", pa.array(sequence + (number << 40))) \
            .append_column("offset", pa.array(offset))

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    of_rests = dealt.groupBy("shard").applyInArrow(
        packed, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(of_rests)


def load_model(path: str) -> str:
    """The vocabulary file, read where the job is submitted (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
