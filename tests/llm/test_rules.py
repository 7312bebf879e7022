"""Rules of printed trees, and accuracy on held-out rows."""

import random
import zlib

from wardflow.llm import rules


def test_paths_of_a_printed_tree():
    text = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= -2.0E-4)
      Predict: 0.0
     Else (feature 1 > -2.0E-4)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 3.0)
      Predict: 1.0
     Else (feature 0 > 3.0)
      Predict: 0.0
"""
    a, b = rules.STATISTICS[:2]
    assert [set(r.conditions) for r in rules.tree_rules(text)] == [
        {(a, True, 1.5)}, {(a, True, 1.5), (b, True, -2e-4)}, {(a, True, 1.5), (b, False, -2e-4)}, {(a, False, 1.5)},
        {(a, False, 1.5), (a, True, 3.0)}, {(a, False, 3.0)}]


def documents(spark, n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        good = i % 3 > 0
        rows.append((i, " ".join(words if good else [w + rng.choice(["$$", "##", ""]) for w in words]), 0.5))
        labels.append((i, int(good)))
    rows += [(None, None, 0.5), (5000, "", 0.5), (0, rows[0][1], 0.5)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality long"), dict(labels))


def test_held_out_rows(spark):
    docs, labels, truth = documents(spark)
    scored, model = rules.score_documents(docs, labels)
    got = scored.collect()
    assert len(got) == 603 and 0 < len(model.weights) < 400
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.93 * len(held)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels, _ = documents(spark, 200)
    flipped = labels.withColumn("quality", (1 - labels.quality)).where(rules.held_out(labels.doc_id)).union(
        labels.where(~rules.held_out(labels.doc_id)))
    key = lambda df: sorted((str(r.doc_id), r.score) for r in df.collect())
    assert key(rules.score_documents(docs, labels)[0]) == key(rules.score_documents(docs, flipped)[0])


def test_without_labels(spark):
    docs, labels, _ = documents(spark, 20)
    assert {r.score for r in rules.score_documents(docs, labels.where("false"))[0].collect()} == {0.5}
    one = rules.score_documents(docs, labels.where("quality = 1"))[0]
    assert {r.predicted for r in one.collect()} == {1}
    assert rules.score_documents(docs.where("false"), labels)[0].collect() == []
