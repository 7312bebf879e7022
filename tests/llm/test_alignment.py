"""Alignment of two tokenizers against a plain one per text, token by token."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardflow.llm import alignment, queries

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
EMPTY = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*PATHS)


def plain(libraries, aligner, text):
    """(groups, links) of one text, or nothing where the bytes differ."""
    if not text:
        return None
    ids = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    spans = []
    for known, of in zip((aligner.bytes_a, aligner.bytes_b), ids):
        at, found = 0, []
        for i in of:
            found.append((at, at + len(known[i]), i))
            at += len(known[i])
        spans.append(found)
        if b"".join(known[i] for i in of) != (" " + text).encode():
            return None
    links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
    groups, begin = [], 0
    for end in sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}):
        groups.append("|".join(",".join(str(i) for s, e, i in side if begin < e <= end) for side in spans))
        begin = end
    return len(ids[0]), len(ids[1]), groups, links


def expected(libraries, aligner, texts):
    found = [plain(libraries, aligner, t) for t in texts]
    counts = Counter(pair for f in found if f for pair in f[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    rows = []
    for f in found:
        rows.append(EMPTY if f is None else (
            f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == top[p[1]] for p in f[3]), sum(counts[p] for p in f[3]),
            hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return rows, counts


def texts():
    rng = random.Random(3)
    yield from ["", " ", "  ", "a", " a", "a ", "a  ", "a\n", "a \n b", "a\n b", "\n", "\t x", "don't we'll", "漢字 かな", "é ñ 😀 ok",
                "<|endoftext|> </s> <s>x", "one▁piece here", "▁", "a  b  c", "x\x00y z", "﻿bom", "ﬁne ½ Å",
                "word " * 400, "ab" * 600, "tail\u0085 x", "\x1c \x1d a"]
    pools = ["abc def", "the of and ", " \n\t ", "éßñ漢字😀", "'=-_ #", "0123456789 "]
    for _ in range(60):
        pool = "".join(rng.sample(pools, rng.randint(1, 3)))
        yield "".join(rng.choice(pool) for _ in range(rng.choice([5, 60, 300])))


def got(df):
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r["doc_id"]), *[r[c] for c in columns]) for r in df.collect())


def want(ids, rows):
    return sorted((str(i), *r) for i, r in zip(ids, rows))


def test_equals_token_by_token(spark, libraries, aligner, monkeypatch):
    given = list(texts())
    rows, counts = expected(libraries, aligner, given)
    assert sum(r != EMPTY for r in rows) > 60 and rows[given.index("one▁piece here")] == EMPTY
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(3)
    found, pairs = alignment.align_documents(docs, *PATHS)
    assert got(found) == want(range(len(given)), rows)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts
    # Small limits: many chunks of one text, several slices of the pairs, a cache that forgets.
    for name, value in {"CHUNK": 40, "SLICE": 300, "HELD": 50, "LEARN": 3, "CACHE": 10}.items():
        monkeypatch.setattr(alignment, name, value)
    assert got(alignment.align_documents(docs, *PATHS)[0]) == want(range(len(given)), rows)


def test_without_borders(libraries, aligner, monkeypatch):
    """A model whose pieces cross spaces has its texts tokenised whole."""
    monkeypatch.setattr(aligner, "borders", False)
    assert aligner.parts("two words") == ["two words"]


def test_copies_nulls_and_other_columns(spark, libraries, aligner):
    given = [(1, "the same words"), (2, "the same words"), (None, "the same words"), (None, None), (3, None), (3, ""),
             (4, "other words"), (4, "other words")]
    rows, _ = expected(libraries, aligner, [t for _, t in given])
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("n_a", F.lit("x"))
    assert got(alignment.align_documents(docs, *PATHS)[0]) == want([i for i, _ in given], rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    found, pairs = alignment.align_documents(none, *PATHS)
    assert found.count() == 0 and pairs.count() == 0


def test_query_columns(spark):
    df = queries.op11_cross_alignment(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    total = df.agg(F.count(F.lit(1)), F.sum("n_links"), F.min("n_groups")).first()
    assert total[0] == 200 and total[1] > 0
