"""Exact shard sizes, gapless slots, uniform outcomes."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wardflow.llm import sharding


def test_matrix_sums():
    m = sharding.matrix([10, 0, 1, 2000, 333], 24, 3)
    assert m.sum(axis=1).tolist() == [10, 0, 1, 2000, 333] and np.ptp(m.sum(axis=0)) <= 1


def test_large_draws_follow_the_law():
    rng = np.random.default_rng(5)
    good, bad, n = 3 * 10**9, 5 * 10**9, 10**6
    draws = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(2000)])
    mean, sd = n * 3 / 8, (n * 3 / 8 * 5 / 8) ** 0.5
    assert abs(draws.mean() - mean) < sd / 8 and abs(draws.std() / sd - 1) < 0.08
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 5, 0, 3) == 3


def test_rows_get_one_place_each(spark):
    rows = [(i % 50, "same" if i % 3 else None, i) for i in range(1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(7)
    out = sharding.assign(docs, 24, block_rows=5).collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == 1003 and set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert Counter(r.doc_id for r in out) == Counter(i % 50 for i in range(1003))
    again = sharding.assign(docs, 24, block_rows=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert sharding.assign(docs.where("false")).collect() == []


def test_places_are_uniform():
    places = Counter()
    for seed in range(400):
        m = sharding.matrix([3, 5], 4, seed)
        shard, _ = sharding._dealt(seed, 0, tuple(m[0].tolist()))
        places.update((i, int(s)) for i, s in enumerate(shard))
    assert all(60 < n < 140 for n in places.values()) and len(places) == 12
