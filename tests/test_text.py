import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from helpers import rows
from pyspark.ml.feature import HashingTF
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wardflow.functions.numbers import coerce_number, round_numbers
from wardflow.functions.vectors import cosine
from wardflow.operators.classify import (
    causes_of, classify, classify_with, contributions, fit_text_models, sector_named, validate, word_slots)
from wardflow.operators.encode import embed, hashing_encoder
from wardflow.operators.retrieval import centroids, similarity_to_group, top_k_similar, top_k_with_report, with_context
from wardflow.operators.texts import kb_chunks, split_rejects
from wardflow.schemas import CLASSIFICATION


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(texts)], "source string, text string")


@pytest.mark.parametrize("text, pieces", [
    ("", 0), ("x", 1), ("x" * 1000, 1), ("x" * 1001, 2), ("x" * 2000, 2), ("né\r\n\t çà" * 700, 6),
    ("a\U0001F600" * 1500, 3), ("\n" * 1500, 2), ("é " * 400, 2)])
def test_chunks_put_together_are_the_text(spark, text, pieces):
    out = [r.text for r in kb_chunks(docs(spark, text)).orderBy("chunk_no").collect()]
    assert out == [text[i:i + 1000] for i in range(0, len(text), 1000)]
    assert len(out) == pieces


def test_null_text_has_no_chunk(spark):
    assert kb_chunks(docs(spark, None)).count() == 0


def test_long_text_is_cut_in_one_pass(spark):
    text = "".join(random.Random(2).choices("abcé \n", k=2_000_000))
    out = kb_chunks(docs(spark, text)).orderBy("chunk_no").collect()
    assert len(out) == 2000 and "".join(r.text for r in out) == text


def test_texts_without_content_are_rejected(spark):
    ok, bad = split_rejects(docs(spark, "x", "", None, "  "))
    assert rows(ok, "source") == [("d0",), ("d3",)]
    assert rows(bad, "source", "status_code") == [("d1", 400), ("d2", 400)]
    ok, bad = split_rejects(docs(spark, "x", "", None, "  "), blank_too=True)
    assert ok.count() == 1 and bad.count() == 3


def test_numbers_from_text(spark):
    given = [("12", 12.0), (" 1e3 ", 1000.0), ("12d", None), ("3.5F", None), ("abc", None), ("", None), (None, None), ("-7.25", -7.25)]
    df = spark.createDataFrame(given, "s string, want double").select(coerce_number("s").alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.125, "a"), (0.375, "b"), (2.5, "c")], "x double, s string")
    assert rows(round_numbers(df), "s", "x") == [("a", 0.12), ("b", 0.38), ("c", 2.5)]


def test_cosine_of_zero_is_zero(spark):
    df = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [-1.0, -1.0])],
                               "a array<float>, b array<float>")
    assert [round(r[0], 9) for r in df.select(cosine("a", "b")).collect()] == [1.0, 0.0, -1.0]


def test_hashing_encoder_counts_words(spark):
    v = hashing_encoder(64)(pd.Series(["Luz luz céu", "", "céu  LUZ\nluz"]))
    assert v.shape == (3, 64) and v[0].sum() == 3 and v[1].sum() == 0
    assert (v[0] == v[2]).all()


def test_encoder_can_be_exchanged(spark):
    out = embed(docs(spark, "abc", "de"), lambda: lambda s: np.stack([[len(x), 1.0] for x in s]))
    assert rows(out, "source", "vector") == [("d0", [3.0, 1.0]), ("d1", [2.0, 1.0])]


def brute(corpus, queries, k):
    def unit(v):
        n = np.linalg.norm(v)
        return v / n if n else v
    want = {}
    for qid, q in queries:
        sims = sorted(((-round(float(unit(np.array(q)) @ unit(np.array(v))), 9) + 0.0, cid) for cid, v in corpus))
        want[qid] = [cid for _, cid in sims[:k]]
    return want


def vectors(n, dims, seed):
    rnd = np.random.default_rng(seed)
    return [(i, [float(x) for x in rnd.integers(-3, 4, dims)]) for i in range(n)]


def test_tasks_hold_few_texts_at_a_time(spark):
    """What an encoder gets is bounded, however many texts a batch has."""
    texts = spark.range(0, 6000, 1, 1).select("id", F.concat(F.lit("w"), "id").alias("text"))
    out = embed(texts, lambda: lambda s: np.stack([[len(s), len(x)] for x in s]))
    assert out.agg(F.max(F.col("vector")[0])).first()[0] <= 2500 and out.count() == 6000
    assert rows(out.select("id", F.col("vector")[1].cast("int")).where("id IN (7, 4999)")) == [(7, 2), (4999, 5)]


def test_vectors_of_different_lengths_are_refused(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0, 1.0]), (2, [1.0])], "id long, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="one length"):
        top_k_similar(c, c.where("id = 2"), 1, corpus_id="id", query_id="id").count()


@pytest.mark.parametrize("limits", [{}, {"max_broadcast_queries": 7, "corpus_block_rows": 40}])
def test_top_k_equals_brute_force(spark, limits):
    corpus, queries = vectors(400, 6, 1), vectors(23, 6, 2)
    # A third of the corpus are copies of one vector: ties must still come in id order.
    corpus += [(10_000 + i, corpus[0][1]) for i in range(200)]
    queries += [(900, corpus[0][1]), (901, [0.0] * 6)]
    c = spark.createDataFrame(corpus, "vec long, vector array<double>").repartition(5)
    q = spark.createDataFrame(queries, "qid long, vector array<double>")
    out = top_k_similar(c, q, 3, corpus_id="vec", query_id="qid", **limits)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.corpus_id)
    assert got == brute(corpus, queries, 3)


def test_top_k_of_few_rows_and_of_none(spark):
    c = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "id string, vector array<double>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "id string, vector array<double>")
    out = top_k_similar(c, q, 3, corpus_id="id", query_id="id")
    assert rows(out, "rank", "corpus_id", "similarity") == [(1, "a", 1.0), (2, "b", 1.0)]
    assert top_k_similar(c.limit(0), q, 3, corpus_id="id", query_id="id").count() == 0
    assert top_k_similar(c, q.limit(0), 3, corpus_id="id", query_id="id").count() == 0


def test_five_thousand_queries_skip_most_pairs(spark):
    # Both sides lie around the same 40 directions, a third of the corpus around one of them.
    rnd = np.random.default_rng(3)
    middles = rnd.normal(size=(40, 8))

    def near(n, seed, hot=0):
        r = np.random.default_rng(seed)
        which = np.where(np.arange(n) < hot, 0, r.integers(0, 40, n))
        return middles[which] + r.normal(scale=0.02, size=(n, 8))
    corpus, asked = near(6000, 4, 2000), near(5000, 5)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec long, vector array<double>").repartition(3)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "qid long, vector array<double>")
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (corpus, asked)]
    sims = np.round(unit[1] @ unit[0].T, 9)
    want = [(i, j) for i, row in enumerate(sims) for j in np.lexsort((np.arange(6000), -row))[:3]]
    for most in (None, 1500):
        hits, report = top_k_with_report(c, q, 3, corpus_id="vec", query_id="qid", max_broadcast_queries=most)
        assert [(r.query_id, r.corpus_id) for r in hits.orderBy("query_id", "rank").collect()] == want
        met = report.first()
        assert met.pairs == 5000 * 6000 and met.scored < 0.25 * met.pairs


def test_vectors_of_zeros_and_none(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [-1.0, 0.0])], "vec long, vector array<double>")
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [2.0, 0.0])], "qid long, vector array<double>")
    ids = {"corpus_id": "vec", "query_id": "qid"}
    assert rows(top_k_similar(c, q, 2, **ids), "query_id", "corpus_id", "similarity", by=["query_id", "rank"]) == [
        (1, 1, 0.0), (1, 2, 0.0), (3, 1, 1.0), (3, 2, 0.0)]
    assert rows(top_k_similar(c, q, 2, above=0.0, **ids), "query_id", "corpus_id") == [(3, 1)]


def test_context_and_citations(spark):
    corpus = spark.createDataFrame([("a#0", "a", "Pedra"), ("a#1", "a", "Papel"), ("b#0", "b", "Folha")],
                                   "chunk_id string, source string, text string")
    hits = spark.createDataFrame([("q", 1, "a#1", 0.9), ("q", 2, "b#0", 0.8), ("q", 3, "a#0", 0.7)],
                                 "query_id string, rank int, corpus_id string, similarity double")
    out = with_context(hits, corpus, "chunk_id").first()
    assert out.context == "Papel\n\nFolha\n\nPedra" and out.citations == ["a", "b"]


def test_means_by_group(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [4.0, 4.0])], "g int, vector array<double>")
    assert rows(centroids(df, "g")) == [(1, [0.5, 0.5]), (2, [4.0, 4.0])]
    assert [round(r.similarity, 6) for r in similarity_to_group(df, "g").orderBy("g").collect()] == [0.707107, 0.707107, 1.0]


def test_classification_learns_and_validates(spark, tmp_path):
    texts = [("monitor broken alarm failed", 1, 1), ("delay in lab results", 0, 0)] * 15
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "id int, text string, kind int, severe int")
    # An observation makes the session unfit for tasks; scoring must not depend on it.
    df.observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    model = fit_text_models(df, ["kind", "severe"], str(tmp_path / "model"))
    out = classify(df, model, "kind", "severe", ("Delay", "Equipment Failure"))
    assert out.schema["classification"].dataType.fieldNames() == CLASSIFICATION.fieldNames()
    flat = out.select("kind", "classification.*")
    assert rows(flat.select("kind", "category").distinct()) == [(0, "Delay"), (1, "Equipment Failure")]
    assert rows(flat.select("kind", "severity").distinct()) == [(0, "Low"), (1, "Critical")]
    assert validate(flat).where("problem IS NOT NULL").count() == 0


def test_causes_equal_the_coefficients(spark, tmp_path):
    """Contributions against the stored coefficients, hashed and weighted by hand."""
    texts = [("monitor broken alarm alarm failed", 1, 1), ("delay in lab results", 0, 0), ("Alarm in lab", 1, 0)] * 10
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "id int, text string, kind int, severe int")
    model = fit_text_models(df, ["kind", "severe"], str(tmp_path / "model"))
    asked = spark.createDataFrame([(1, "Alarm alarm unseen lab"), (2, ""), (3, None), (4, "delay delay"), (5, "monitor")],
                                  "id int, text string")
    got = {(r.id, r.word): r.contribution for r in contributions(asked, model, "severe", "id").collect()}
    (_, hashing, idf), linear = model.stages[0].stages, model.stages[2]
    assert linear.getPredictionCol() == "is_severe"
    want = {}
    for i, text in ((1, "alarm alarm unseen lab"), (4, "delay delay"), (5, "monitor")):
        for w in set(text.split()):
            slot = hashing.indexOf(w)
            want[i, w] = text.split().count(w) * idf.idf[slot] * linear.coefficients[slot]
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    raw = {r.id: r.raw_severe[1] for r in model.transform(asked.where("id IN (1, 2)")).collect()}
    assert abs(raw[1] - linear.intercept - sum(v for (i, _), v in got.items() if i == 1)) < 1e-9
    causes = {r.id: r.root_cause for r in causes_of(contributions(asked, model, "severe", "id"), "id", 2).collect()}
    positive = {i: sorted((-v, w) for (j, w), v in want.items() if j == i and v > 0) for i in (1, 4, 5)}
    assert causes == {i: ", ".join(w for _, w in p[:2]) for i, p in positive.items() if p}
    assert "alarm" in causes[1] and causes[5] == "monitor" and 4 not in causes
    out = classify(asked.where("text IS NOT NULL").withColumn("sector", F.lit(None).cast("string")), model, "kind", "severe",
                   ("Delay", "Equipment Failure"), F.col("sector"), sectors=("Lab", "ER"), causes=2)
    flat = {r.id: (r.root_cause, r.impacted_sector) for r in out.select("id", "classification.*").collect()}
    assert flat == {1: (causes[1], "Lab"), 2: (None, None), 4: (None, None), 5: ("monitor", None)}


def test_slots_are_those_of_the_hashing_stage(spark):
    hashing = HashingTF(numFeatures=1 << 13)
    words = ["", "a", "né", "abc", "alarm", "céu-luz", "monitor", "\U0001f600x", "x" * 1001, *[f"w{i}" * (i % 7) for i in range(200)]]
    assert word_slots(pa.array(words), 1 << 13).tolist() == [hashing.indexOf(w) for w in words]


def test_classification_is_one_pass(spark, tmp_path):
    """No shuffle of the words of all texts, and the same causes as by their contributions."""
    texts = [("monitor broken alarm alarm failed", 1, 1), ("delay in lab results", 0, 0), ("Alarm in lab", 1, 0)] * 10
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "id int, text string, kind int, severe int")
    model = fit_text_models(df, ["kind", "severe"], str(tmp_path / "model"))
    out = classify(df, model, "kind", "severe", ("Delay", "Equipment Failure"), causes=2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    want = {r.id: r.root_cause for r in causes_of(contributions(df, model, "severe", "id"), "id", 2).collect()}
    assert {r.id: r.root_cause for r in out.select("id", "classification.root_cause").collect() if r.root_cause} == want


def test_first_sector_named(spark):
    df = spark.createDataFrame([("Late in the er, then ICU-2 free",), ("icu 2 and ER",), ("other paper",), ("",), (None,), ("x.ER",)],
                               "text string")
    assert [r[0] for r in df.coalesce(1).select(sector_named(F.col("text"), ["ER", "ICU 2"])).collect()] == [
        "ER", "ICU 2", None, None, None, "ER"]


def test_validation_rules(spark):
    df = spark.createDataFrame([
        ("Delay", "Low", None, None, "x", 0.5), (None, "Low", None, None, "x", 0.5), ("Delay", "Mild", None, None, "x", 0.5),
        ("Delay", "Low", None, None, None, 0.5), ("Delay", "Low", None, None, "x", 1.5),
        ("Delay", "Low", None, None, "x", float("nan")), ("Delay", "Low", None, None, "x", 1.0)], CLASSIFICATION)
    assert [r.problem for r in validate(df.coalesce(1)).collect()] == [
        None, "category missing", "severity not allowed", "action missing", "confidence out of range",
        "confidence out of range", None]


def test_external_client(spark):
    def make_client():
        return lambda s: pd.DataFrame({
            "category": ["Delay"] * len(s), "severity": "Low", "root_cause": None, "impacted_sector": None,
            "suggested_action": [x.upper() for x in s], "confidence": 0.5})
    out = classify_with(docs(spark, "a", "b"), make_client)
    assert rows(out, "source", "suggested_action", "root_cause") == [("d0", "A", None), ("d1", "B", None)]
