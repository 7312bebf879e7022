"""Fingerprint links against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import graph, simhash


def brute(sigs, budget):
    """Smallest index of each component over links of `budget` bits or fewer."""
    values = np.array([s[0] for s in sigs], dtype=np.int64).view(np.uint64)
    root = list(range(len(values)))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= budget).tolist() for v in values]
    while changed:
        changed = False
        for i, others in enumerate(near):
            least = min(root[j] for j in others)
            if least < root[i]:
                root[i], changed = least, True
    return root


def clustered(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = rng.getrandbits(64) if not out or rng.random() < 0.3 else rng.choice(out)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("limit", [16384, 8])
def test_links_lose_nothing(spark, limit):
    values = [x - (1 << 64) if x >> 63 else x for x in clustered(400, limit)]
    nodes = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "_node long, sig array<long>")
    got = {r.node: r.component for r in graph.components(simhash.links(nodes, 3, None, limit)).collect()}
    want = brute([[v] for v in values], 3)
    assert [got.get(i, i) for i in range(len(values))] == want


def test_one_dense_cluster(spark):
    values = [a | b << 20 | c << 40 for a in range(16) for b in range(8) for c in range(4)]
    nodes = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "_node long, sig array<long>")
    got = graph.components(simhash.links(nodes, 3, None, 20)).collect()
    assert len(got) == len(values) and {r.component for r in got} == {0}


def test_one_fingerprint_of_many_nodes(spark):
    """Eight places, of which one is the same in all nodes; the first two decide."""
    rng = random.Random(7)
    bits = lambda: rng.getrandbits(64) - (1 << 63)
    flipped = lambda x, n: x ^ sum({1 << rng.randrange(63) for _ in range(n)})
    centres = [(bits(), bits()) for _ in range(9)]
    sigs = []
    for i in range(120):
        a, b = centres[i % 9]
        sigs.append([flipped(a, i % 7), flipped(b, i // 9 % 8), bits(), -5, *[bits() for _ in range(4)]])
    sigs += [[*sigs[0][:3], -5, *[bits() for _ in range(4)]] for _ in range(9)]  # equal in both check places
    nodes = spark.createDataFrame(list(enumerate(sigs)), "_node long, sig array<long>")
    got = {r.node: r.component for r in graph.components(simhash.links(nodes, 3, 15, 16)).collect()}
    check = np.array([s[:2] for s in sigs], dtype=np.int64).view(np.uint64)
    near = [np.flatnonzero(np.bitwise_count(check ^ c).sum(axis=1) <= 15).tolist() for c in check]
    root, changed = list(range(len(sigs))), True
    while changed:
        changed = False
        for i, others in enumerate(near):
            least = min(root[j] for j in others)
            changed, root[i] = changed or least < root[i], min(least, root[i])
    assert [got.get(i, i) for i in range(len(sigs))] == root and 9 <= len(set(root)) < 60


def test_whole_values_are_dealt_in_bounded_units(spark):
    rows = spark.range(300).selectExpr(
        "1L AS _t", "-5L AS _a", "-5L AS _b", "0 AS _side", "0 AS _d", "-5L AS _v", "id AS _node", "id % 200 AS _c0", "0L AS _c1")
    equal, tiled = simhash._whole_values(rows, 40)
    assert equal.count() == 100
    units = {}
    for r in tiled.collect():
        units.setdefault((r._t, r._a, r._b), []).append((r._side, r._node))
    assert max(map(len, units.values())) <= 80
    met = {frozenset((a, b)) for u in units.values() for s, a in u for z, b in u if a != b and (s, z) in ((0, 0), (1, 2))}
    assert len(met) == 200 * 199 // 2


def test_components_of_a_path(spark):
    links = spark.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {(r.node, r.component) for r in graph.components(links).collect()} == {(i, 0) for i in range(61)}
    assert graph.components(links.where("u < 0")).collect() == []


def test_fingerprint_of_few_words():
    assert simhash.signature("", 3, 1) == [0] and simhash.signature(" \n\t", 3, 1) == [0]
    assert simhash.signature("One TWO", 3, 1) == simhash.signature("one\x0btwo", 3, 1)
    assert simhash.shingles("a b c d", 3) == [b"a b c", b"b c d"]
    assert simhash.shingles("É a\xa0b", 3) == ["É a\xa0b".encode()]


def test_rows_and_ties(spark):
    rows = [(7, None), (3, ""), (None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (5, "other words here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", F.lit(1))
    got = sorted((r._id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 9), (3, 3), (5, 5), (7, 3), (9, 9), (9, 9)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 9]
    assert simhash.near_duplicates(docs.where("false")).collect() == []


def test_unrelated_texts_stay_whatever_their_ids(spark):
    texts = ["one text of some words here", "quite another matter, nothing alike", "third thing: rain over hills", "a fourth, last of all"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (6, texts[3]), (None, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {tuple(r) for r in simhash.keep_one(docs).collect()}
    assert kept == {(None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3])}
    assert simhash.keep_one(docs).count() == 4


def test_near_copies_go(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for g in range(12):
        base = [word() for _ in range(200)]
        rows.append((10 * g, " ".join(base)))
        for k in range(1, 4):
            copy = list(base)
            copy[rng.randrange(200)] = word()
            rows.append((10 * g + k, " ".join(copy)))
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [10 * g for g in range(12)]
