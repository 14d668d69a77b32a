"""BPE against the tiktoken library and exact round trips."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from citystream.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(5)
    alphabet = "abcdeABCXYZ 019.,!'\n\t\r\x1c\x85\xa0\u2003éßñ漢字😀\u0301ñ<|>"
    out = ["", " ", "a" * 5000, "ab" * 4000 + "é" * 3000 + " " * 2000, "it's we'll I'D", "<|endoftext|>", "\U0001F469\u200D\U0001F4BB x"]
    return out + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 120))) for _ in range(400)]


def test_equals_the_library_and_decodes(ranks, library):
    e = bpe.Encoder(ranks, P.PATTERN)
    for t in texts():
        ids = e.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t
        assert e.decode(ids) == t.encode()
    assert not any(e.queue.buckets) and not any(e.queue.low)


def test_pieces_merged_together(ranks, library):
    e = bpe.Encoder(ranks, P.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode_all([None, *texts()])] == [[], *(library.encode_ordinary(t) for t in texts())]


def test_lower_rank_comes_first():
    """Merging 'bc' makes 'abc', of lower rank, before the next 'bc' of the piece."""
    ranks = {bytes((b,)): 1000 + b for b in range(256)} | {b"abc": 0, b"abcb": 1, b"bc": 2, b"cb": 3}
    want = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    e = bpe.Encoder(ranks, r"\S+")
    rnd = random.Random(2)
    for t in ["abcbc abcb bcbcabcbcbc", *("".join(rnd.choice("abc ") for _ in range(60)) for _ in range(100))]:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == want.encode_ordinary(t)


def test_every_document(ranks, library):
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column(0).to_pylist()
    e = bpe.Encoder(ranks, P.PATTERN)
    for text, ids in zip(docs, e.encode_all(docs)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text or "")


def test_pieces_forgotten_and_met_again(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "STRETCH", 50)
    e = bpe.Encoder(ranks, P.PATTERN)
    for t in texts()[-60:] * 2:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_frames(spark, ranks):
    df = spark.createDataFrame([(1, "hello wörld", "x"), (1, "hello wörld", "x"), (None, None, None), (2 ** 60 + 1, "", "y")],
                               "doc_id long, text string, n_tokens string")
    out = bpe.round_trip_digests(df, ranks, P.PATTERN).collect()
    assert sorted(r.n_tokens for r in out)[:2] == [0, 0] and len(out) == 4
    assert {r.doc_id for r in out} == {1, None, 2 ** 60 + 1}
    ids = bpe.encode(df, ranks, P.PATTERN)
    back = {(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(ids, ranks, P.PATTERN).collect()}
    assert back == {(1, "hello wörld"), (None, ""), (2 ** 60 + 1, "")}
    assert bpe.round_trip_digests(df.limit(0), ranks, P.PATTERN).count() == 0
