"""Tree encoding against the library, on texts that cut badly."""

import hashlib
import random

import public_tokenizers as P
import pytest

from wardflow.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def texts():
    rng = random.Random(5)
    pools = ["abcdefghij klmnop", "aaaaaaaaab", " \n\t\r  x", "é ñ漢字😀 ", "'rstlvemd ", "=-=-= _", "0123456789abcdef",
             "\x1c\x85\xa0 　 a", "thereingtionand  "]
    yield from ["", " ", "a", "\n", " " * 5000, "a" * 9001, "ab" * 5000, "=" * 7777, "漢" * 3000, "don't we'll " * 900,
                "\x1c \x1c" * 3000]
    for _ in range(150):
        pool = "".join(rng.sample(pools, rng.randint(1, 3)))
        yield "".join(rng.choice(pool) for _ in range(rng.choice([10, 1100, 2500, 9000])))


def test_equals_library(codec, monkeypatch):
    for leaf in (1024, 7):
        monkeypatch.setattr(bpe, "LEAF", leaf)
        for text in texts():
            ids = codec.encode(text)
            assert ids.tolist() == codec.library.encode_ordinary(text), text[:80]
            assert codec.decode(ids) == text.encode()


def test_windows_match_by_match(codec, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 16)
    monkeypatch.setattr(bpe, "PIECE", 5)
    for text in texts():
        assert codec.encode(text).tolist() == codec.library.encode_ordinary(text), text[:80]


def test_each_token_is_its_own_encoding(codec):
    """What the pair test rests on."""
    assert all(codec.merge(b) == [i] for b, i in codec.ranks.items() if len(b) < 40)


def test_long_merges(codec):
    for piece in (b"thereingtionand" * 9, b"a" * 301, bytes(range(256))):
        assert codec.merge_long(piece) == codec.merge(piece)


def test_rows(spark, codec):
    rows = [(1, None, "x"), (2, "", "x"), (None, "some words", "x"), (3, "some words", "x"), (3, "some words", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("n_tokens", docs_extra())
    got = bpe.digests(bpe.encode_texts(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)).collect()
    want = hashlib.sha256(b"some words").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in got) == [
        (0, 2, want), (1, 0, empty), (2, 0, empty), (3, 2, want), (3, 2, want)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_texts(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit(1)
