"""Phrase mining against plain counting of all n-grams."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardflow.llm import collocations, queries

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
TO_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top=collocations.TOP, least=collocations.LEAST):
    counts, words_of = Counter(), Counter()
    for lang, text in rows:
        lang = lang or ("und" if lang is None else lang)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(TO_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            counts.update((lang, " ".join(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    chosen = {p: a for p, a in counts.items() if " " in p[1] and a >= least}
    longer = Counter()
    for (lang, phrase), a in chosen.items():
        w = phrase.split(" ")
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inner = lang, " ".join(w[i:i + k])
                longer[inner] = max(longer[inner], a)
    found = {}
    for (lang, phrase), a in chosen.items():
        if 100 * longer[lang, phrase] >= 80 * a:
            continue
        w = phrase.split(" ")
        cuts = [(counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]) for k in range(1, len(w))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, words_of[lang], -score)
                  for lang, rows in found.items() for i, (score, a, p, l, r) in enumerate(sorted(rows)[:top]))


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def made(n=1500, seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "São", "a", "b\x00", "naïve", "x" * 30, "漢字"]
    fixed = ["new york city hall", "of the", "machine learning model", "a a a"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < .3 else rng.choice(words) for _ in range(rng.choice([1, 6, 40]))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", " \x0b"]) for p in parts)
        rows.append((rng.choice(["en", "en", "de", None, ""]), text))
    return rows + [("en", None), ("en", ""), ("en", " ,. "), (None, None), ("fr", "rare words here")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_equals_plain_counting(spark, monkeypatch):
    rows = made()
    want = plain(rows)
    assert {r[0] for r in want} == {"en", "de", "und", ""} and len(want) > 60
    docs = frame(spark, rows).repartition(3)
    assert got(collocations.mine_phrases(docs)) == want
    # Small limits: many segments and buckets, nearly every prefix heavy, a short report.
    for name, value in {"SEGMENT": 200, "BUCKET": 150}.items():
        monkeypatch.setattr(collocations, name, value)
    assert got(collocations.mine_phrases(docs, 7)) == plain(rows, 7)
    for heavy in (10**9, 60, 1):
        monkeypatch.setattr(collocations, "HEAVY", heavy)
        assert got(collocations.mine_phrases(docs)) == want


def test_windows_are_padded_at_pieces():
    words, ids = collocations.windows("A b\tc  d. e,\nF")
    names = ["-", *words.to_pylist()]
    assert [[names[i] for i in w] for w in ids.tolist()] == [
        ["a", "b", "c", "d"], ["b", "c", "d", "-"], ["c", "d", "-", "-"], ["d", "-", "-", "-"],
        ["e", "-", "-", "-"], ["f", "-", "-", "-"]]


def test_long_texts_are_cut_at_ends_of_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 10)
    text = "one two three. four five, six seven eight nine ten"
    assert "".join(collocations._segments([text])) == text
    assert list(collocations._segments([text]))[0] == "one two three."


def test_hot_word_and_pair(spark, monkeypatch):
    """Windows of a pair with a third of all are dealt by a further word."""
    monkeypatch.setattr(collocations, "BUCKET", 500)
    monkeypatch.setattr(collocations, "HEAVY", 50)
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice(["of the", f"w{rng.randint(0, 300)}"]) for _ in range(40))) for _ in range(400)]
    docs = frame(spark, rows)
    total, heavy = collocations.heavy_prefixes(docs)
    assert {p for _, p, _ in heavy} >= {"of", "of the"}
    blocks = collocations.window_blocks(docs, heavy, 40).groupBy("bucket").count()
    assert blocks.count() == 40
    assert got(collocations.mine_phrases(docs)) == plain(rows)


def test_numbers_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**18
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big)]
    counts = spark.createDataFrame(rows, "lang string, n_words int, phrase string, f long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda docs: counts)
    assert got(collocations.mine_phrases(counts)) == [("en", 1, "a b", big, big, big, big, 1_000_000)]


def test_rows_nulls_and_other_columns(spark):
    rows = [("en", "same words")] * 30 + [(None, "same words")] * 29 + [(None, None)]
    docs = frame(spark, rows).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x"))
    assert got(collocations.mine_phrases(docs)) == [("en", 1, "same words", 30, 30, 30, 60, 1_000_000)]
    assert got(collocations.mine_phrases(frame(spark, []))) == []


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="no given tables")
def test_query_equals_plain_counting(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()
    assert got(queries.op13_phrase_collocations(spark, "/root/testdata/sf0.001")) == plain([tuple(r) for r in rows])
