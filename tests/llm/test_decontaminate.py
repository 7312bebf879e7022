"""Passages against edit distances of all windows; recall of the repeated keys."""

import random

import numpy as np

from wardflow.llm import decontaminate as D


def edited(words, k, rng):
    out = list(words)
    for _ in range(k):
        i = rng.randrange(len(out))
        what = rng.choice("sid")
        if what == "s":
            out[i] = "zz" + str(rng.randrange(10**9))
        elif what == "i":
            out.insert(i, "yy" + str(rng.randrange(10**9)))
        else:
            del out[i]
    return out


def test_edit_span():
    a, t = np.array([1, 2, 3, 4]), np.array([9, 9, 1, 2, 3, 4, 9])
    assert D.edit_span(a, t) == (0, 2, 6)
    assert D.edit_span(a, np.array([9, 1, 2, 7, 4]))[0] == 1
    assert D.edit_span(a, np.array([], dtype=int))[0] == 4


def test_passages(spark):
    rng = random.Random(12)
    vocabulary = ["w%d" % i for i in range(300)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(7, 60))] for _ in range(40)]
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, want = [], set()
    for d in range(400):
        t = rng.randrange(len(items))
        k = rng.randint(0, D.edits_allowed(len(items[t])))
        docs.append((d, " ".join(noise(rng.randint(0, 80)) + edited(items[t], k, rng) + noise(40)).upper()))
        want.add((d, t))
    docs += [(1000 + i, " ".join(noise(200))) for i in range(100)] + [(2000, None), (2001, ""), (None, " ".join(items[0])), (2002, items[1][0])]
    rows = [(d, t, 7) for d, t in docs]
    table = spark.createDataFrame(rows, "doc_id long, text string, edits int").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    for block in (20_000, 13):
        got = D.find_passages(table, bench, block).collect()
        found = {(r._id, r.item_id) for r in got}
        assert found <= want | {(None, 0)} and (None, 0) in found
        assert len(found & want) >= 0.985 * len(want)
        for r in got:
            assert r.edits <= D.edits_allowed(r.n_words)
    r = next(r for r in got if r._id is None)
    assert (r.start, r.end, r.edits) == (0, len(" ".join(items[0])), 0)
    assert D.find_passages(table.where("false"), bench).collect() == []
    assert D.find_passages(table, bench.where("false")).collect() == []


def test_windows_lose_nothing():
    rng = random.Random(3)
    item = ["w%d" % i for i in range(30)]
    known = D.Items([(1, " ".join(item))])
    for _ in range(200):
        words = edited(item, rng.randint(0, D.edits_allowed(30)), rng)
        ids = np.array([known.vocabulary.get(w, 0) for w in words], dtype=np.int64)
        assert known.windows(ids)
