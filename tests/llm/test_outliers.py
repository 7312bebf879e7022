"""Counts against brute force; the robust estimate on a made group."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from wardflow.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_counts(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 60, "one\n\none\n one\n", "#*$%&|<> é\x0bü\x85z"]
    texts += ["\n".join(" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 9))) for _ in range(12)) for _ in range(40)]
    texts.append(" ".join(str(i % 4000) for i in range(5000)))
    rows = [(i, t, None if i % 3 else "en", "s", 1.0) for i, t in enumerate(texts)] + [(None, "a", None, None, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, distance2 double")
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
        assert r.kept == (not r.base_failed), "too few rows for an estimate"
    assert outliers.judge(docs.where("false")).collect() == []


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(4)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    clean = [" ".join(word(rng.randint(2, 9)) for _ in range(rng.randint(50, 800))) for _ in range(300)]
    odd = [" ".join(word(5) + "$$$" for _ in range(200)) for _ in range(40)] + [" ".join(word(60) for _ in range(200)) for _ in range(40)]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + odd)]
    out = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3))
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert kept == set(range(300))


def test_small_groups_are_judged(spark):
    """By their language if that has enough rows, else by the whole table."""
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    clean = lambda: " ".join(word(rng.randint(2, 9)) for _ in range(rng.randint(50, 800)))
    odd = lambda: " ".join(word(60) + "$$$" for _ in range(200))
    groups = [("en", "s")] * 200 + [("en", None)] * 3 + [("en", "rare")] * 3 + [(None, "s")] * 3 + [("xx", "y")] * 3
    rows = [(i, clean(), *g) for i, g in enumerate(groups)]
    rows += [(1000 + i, odd(), *g) for i, g in enumerate(dict.fromkeys(groups))]
    out = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(out) == len(rows) and all(r.distance2 is not None for r in out)
    assert {r.doc_id for r in out if r.kept} == set(range(len(groups)))


def test_keep_returns_whole_rows(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 9 == 0 else " ".join(str(rng.randint(0, 99)) for _ in range(i % 60)), "en", "s" if i % 3 else None, i, -i)
            for i in range(200)] * 2 + [(None, "a b c d e f g h i j k", None, None, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept long, `_row.x` long")
    judged = outliers.judge(docs.withColumn("again", F.struct("doc_id", "text", "lang", "source", "kept", "`_row.x`")), ("again",))
    want = Counter(tuple(r.again) for r in judged.where("kept").collect())
    out = outliers.keep(docs)
    assert out.schema == docs.schema
    assert Counter(map(tuple, out.collect())) == want and 100 < sum(want.values()) < len(rows)
    assert outliers.keep(docs.where("false")).collect() == []


def test_a_group_of_equal_rows_stays(spark):
    docs = spark.range(100).select("id", F.lit(" ".join(map(str, range(50)))).alias("text")).selectExpr(
        "id AS doc_id", "text", "'en' AS lang", "CAST(NULL AS STRING) AS source")
    assert outliers.judge(docs).where("kept").count() == 100


def test_no_python_in_the_plan(spark):
    docs = spark.range(3).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'s' AS source")
    plan = outliers.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
