"""Packing: ids as the library's, exact pieces, gapless sequences, few of them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from citystream.llm import packing

MODEL = packing.load_model(P.path("word_bpe_49k.json"))


def least_sequences(lengths, size):
    """Best fit, longest first, for comparison; and the bound by volume."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(size - n)
    return len(room), -(-sum(lengths) // size)


def check_places(lengths, sequence, offset, size):
    held = defaultdict(list)
    for n, s, o in zip(lengths, sequence, offset):
        held[s].append((o, n))
    for places in held.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= size
    return len(held)


@pytest.mark.parametrize("kind", ["uniform", "documents", "large", "small", "few", "one", "halves"])
def test_pack(kind):
    rng = np.random.default_rng(5)
    lengths = {"uniform": rng.integers(1, 2048, 4000), "documents": np.clip(rng.lognormal(6.4, 0.8, 4000), 1, 2047).astype(int),
               "large": rng.integers(700, 2047, 3000), "small": rng.integers(1, 200, 3000), "few": np.array([2000, 48, 1, 1030, 1018]),
               "one": np.array([1]), "halves": np.repeat([1024, 683, 682, 300], 500)}[kind].astype(np.int64)
    used = check_places(lengths, *packing.pack(lengths, 2048), 2048)
    plain, bound = least_sequences(lengths.tolist(), 2048)
    assert used <= max(bound + 2, plain) + len(lengths) // 1000


def test_linear_program_is_optimal_on_known_sizes():
    found = packing.configurations(np.array([1024, 683, 682]), np.array([100, 100, 200]), 2048)
    assert sum(x for _, x in found) == pytest.approx(50 + 100, abs=1e-6)
    assert all(int(places @ [1024, 683, 682]) <= 2048 for places, _ in found)
    assert sum(places * x for places, x in found) == pytest.approx([100, 100, 200])


def test_ids_equal_the_library():
    library = Tokenizer.from_str(MODEL)
    rnd = random.Random(3)
    texts = ["".join(map(chr, range(0x180))), "''s 's'S don't I'LL\x85a\xa0b\x0bc\x1cd\x1fe", "İstanbul ΣΑΣ ſ", "a<|endoftext|>b", "é  x"]
    texts += ["".join(rnd.choice([chr(rnd.randrange(0x180)), rnd.choice("ab 's1.\n")]) for _ in range(200)) for _ in range(200)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0x20, 0x3000), 0x301, 0x130, 97])) for _ in range(50)) for _ in range(50)]
    encoder = packing.WordEncoder(MODEL)
    for batch in (texts, texts, [None, "", " "]):
        got = encoder.encode(batch)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t or "", add_special_tokens=False).ids for t in batch]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    monkeypatch.setattr(packing, "STRETCH", 12)
    library, encoder = Tokenizer.from_str(MODEL), packing.WordEncoder(MODEL)
    for batch in (["one two three", "four five"], ["six one seven", "two eight " + "long" * 20], ["one"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(batch)] == [library.encode(t, add_special_tokens=False).ids for t in batch]


def test_documents(spark):
    library, rnd = Tokenizer.from_str(MODEL), random.Random(1)
    words = ["than", "heron", "über", "naïve", "x9", "—"]
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 40, 400])))) for i in range(200)]
    texts += [(500, None), (501, ""), (None, "no id"), (7, "a repeated id"), (7, "a repeated id"), (2 ** 62 + 1, "than " * 20_000), (None, "heron " * 255), (600, "than " * 63), (601, "than " * 64)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in texts], "doc_id long, text string, piece int, row string").repartition(3)
    size = 64
    rows = packing.pack_documents(df, MODEL, size=size, shard=150).collect()
    want = []
    for i, t in texts:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, s, len(ids[s:s + size]), zlib.crc32(ids[s:s + size].tobytes())) for k, s in enumerate(range(0, len(ids), size))]
    assert sorted([tuple(r)[:5] for r in rows], key=str) == sorted(want, key=str)
    used = check_places([r.length for r in rows], [r.sequence_id for r in rows], [r.offset for r in rows], size)
    assert used <= -(-sum(r.length for r in rows) // size) * 1.05 + 3
    assert packing.pack_documents(df.limit(0), MODEL).count() == 0
