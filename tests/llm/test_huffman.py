"""Code lengths against a plain Huffman code, files against the library."""

import gc
import heapq
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from wardflow.llm import huffman


def total_bits(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@pytest.mark.parametrize("n", [2, 3, 50, 1000])
def test_lengths(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(0, 1000, n) ** 2
    counts[:2] += 1
    lengths = huffman.code_lengths(counts, 40)
    assert (lengths * counts).sum() == total_bits(counts)
    short = huffman.code_lengths(counts, max(2, int(np.ceil(np.log2(n))) + 1))
    assert short.max() <= max(2, int(np.ceil(np.log2(n))) + 1)
    for found in (lengths, short):
        assert sum(2.0 ** -int(x) for x in found if x) == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


def test_blocks():
    rng = np.random.default_rng(1)
    docs = [rng.geometric(0.2, size=k) - 1 for k in (0, 1, 255, 256, 257, 3000)]
    counts = np.bincount(np.concatenate(docs))
    lengths = huffman.code_lengths(counts)
    codes, table = huffman.canonical(lengths), huffman.decoding_table(lengths)
    for ids in docs:
        payload, first = huffman.pack(ids, codes, lengths)
        sizes = np.minimum(huffman.BLOCK, len(ids) - np.arange(0, len(ids), huffman.BLOCK))
        assert huffman.unpack(np.frombuffer(payload, np.uint8), first, sizes, table).tolist() == ids.tolist()


def test_added_tokens_as_the_library_has_them():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    words = huffman.Words(P.path("byte_bpe_50k.json"), "<u2")
    texts = ["a plain text", "one<|endoftext|>two words <|endoftext|>", "", "<|endoftext|>", "<|endoftext", "plain again"]
    got = [np.frombuffer(x, "<u2").tolist() for x in words.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[3] == [50256]


def test_words_share_their_parts(monkeypatch):
    """Punctuation and new lines at all places, also with a cache that forgets."""
    rng = random.Random(3)
    words = huffman.Words(P.path("byte_bpe_50k.json"), "<u2")
    parts = ["word", "the", "x1", "2024", "é", "漢", "...", ",", "'", "'s", "\n", "\n\n", "\t", "-", "(", ")", "<|", " ", " ", " ", "  ", "\r\n", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([3, 8, 60]))) for _ in range(3000)]
    texts += ["end.\nNext line", "end\nnext, x", "a.\nb.\nc d", "it's.\nIt's x", "x*** y*** z", "a\n'b c", "(a)\n(b) c", "q?! r"]
    want = [words.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in words.encode(texts)] == want
    monkeypatch.setattr(huffman, "CACHE", 50)
    monkeypatch.setattr(huffman, "PART", 100)
    assert [np.frombuffer(x, "<u2").tolist() for x in words.encode(texts)] == want


def test_learning_leaves_nothing_to_collect():
    """Words that are put together of parts make no object each that the garbage collector has to walk."""
    words = huffman.Words(P.path("byte_bpe_50k.json"), "<u2")
    seen = []
    gc.collect()
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    try:
        words._learn([f"w{i}," for i in range(30_000)])
    finally:
        gc.callbacks.pop()
    assert seen.count("start") < 10
    assert words.known["w7,"] == words._ids(" w7,").astype("<u2").tobytes()


def test_hot_ids_are_dealt_to_several_ranges(spark, tmp_path, monkeypatch):
    """A third of the rows without doc_id, a third with one doc_id, all with one text."""
    monkeypatch.setattr(huffman, "RANGE_IDS", 200)
    rows = [(None, "one two three")] * 300 + [(7, "one two three")] * 300 + [(i, "one two three") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    huffman.write(docs, str(tmp_path / "f"), P.path("byte_bpe_50k.json"), 2)
    segments = spark.read.parquet(str(tmp_path / "f/segments"))
    assert segments.agg(F.max(F.size("doc_ids"))).first()[0] < 120
    found = sorted((r.start, -1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in huffman.read(spark, str(tmp_path / "f")).collect())
    assert [i for _, i, _ in found] == sorted(-1 if i is None else i for i, _ in rows)
    assert [s for s, _, _ in found] == [4 * i for i in range(900)]


def test_files(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    texts = [None, "", " ", "  two  spaces ", "a\n b", "tab\t x", "x\n\n\ny  ", "don't. It's", "\x1c \x1c a", "é ñ 漢字 😀", "<|endoftext|> x"]
    texts += ["".join(rng.choice(["word", " ", "the", ".", "\n", "é", "1", "'s", " and"]) for _ in range(rng.choice([5, 900]))) for _ in range(60)]
    rows = [(None if i == 20 else (i * 37) % 211, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("start", F.lit("x"))
    monkeypatch.setattr(huffman, "RANGE_IDS", 2000)
    monkeypatch.setattr(huffman, "SEGMENT_BYTES", 500)
    huffman.write(docs, str(tmp_path / "f"), P.path("byte_bpe_50k.json"), 2)
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.ids)) for r in huffman.read(spark, str(tmp_path / "f")).collect()}
    library = huffman.Words(P.path("byte_bpe_50k.json"), "<u2").library
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)
    huffman.write(docs.where("false"), str(tmp_path / "none"), P.path("byte_bpe_50k.json"), 2)
    assert huffman.read(spark, str(tmp_path / "none")).collect() == []
