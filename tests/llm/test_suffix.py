"""Repeats against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from wardflow.llm import suffix


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[s:s + suffix.MATCH] for r in raws for s in range(len(r) - suffix.MATCH + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - suffix.MATCH + 1):
            if seen[r[s:s + suffix.MATCH]] > 1:
                gone[s:s + suffix.MATCH] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def corpus():
    rng = random.Random(3)
    text = lambda n, pool="abcdefgh iué": "".join(rng.choice(pool) for _ in range(n))
    passage, other = text(230), text(700)
    base = text(1500)
    near = [base[:k] + "X" + base[k + 1:] for k in (100, 120, 700, 705, 1400)]
    return [None, "", "short", "a" * 199, "b" * 200, "b" * 201, "xy" * 400, base, *near, base[:199], base[:200],
            text(300) + passage + text(50), passage, text(10) + passage[:210], other, other, other,
            other[:350] + text(3) + other[350:], text(90) + text(260) * 3, text(5000), "é" * 100 + text(400)]


@pytest.mark.parametrize("wide", [5000, 1])
def test_equals_all_windows(spark, wide):
    texts = corpus()
    rows = [(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, region string").repartition(3)
    got = suffix.digests(*suffix.remove_repeats(docs, batches=3, wide=wide)).collect()
    want = [(i if i % 7 else None, *w) for i, w in enumerate(brute(texts))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("batches", [1, 7])
def test_any_number_of_batches(spark, batches):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = sorted(tuple(r) for r in suffix.digests(*suffix.remove_repeats(docs, batches=batches)).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts))]


def test_matches_come_from_the_scan(spark, monkeypatch):
    """A family whose new batches are scanned without the levels finds repeats within batches only."""
    scanned = suffix.Family._scanned

    def alone(self, new):
        held, self.tables = self.tables, {}
        try:
            return scanned(self, new)
        finally:
            self.tables = held

    rng = random.Random(8)
    passage = "".join(rng.choice("abcdef gh") for _ in range(300))
    texts = [f"{i} " + "".join(rng.choice("xyzuvw ") for _ in range(150)) + passage for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = lambda: [r.n_removed for r in suffix.digests(*suffix.remove_repeats(docs, batches=8)).orderBy("doc_id").collect()]
    whole = removed()
    assert whole == [w[1] for w in brute(texts)] and all(whole)
    monkeypatch.setattr(suffix.Family, "_scanned", alone)
    assert sum(removed()) < sum(whole) and 0 in removed()


def test_matches_are_those_of_all_entries(spark):
    """Recorded matches against counts over all batches; levels keep to different ranks."""
    rng = random.Random(4)
    parts = [[(rng.randrange(40), rng.randrange(3), rng.randint(1, 2) if rng.random() < 0.2 else 1) for _ in range(12)]
             for _ in range(7)]
    family = suffix.Family(spark, 3)
    for i, part in enumerate(parts, 1):
        family.add(spark.createDataFrame(part, "key long, region long, n long"))
        assert len(family.tables) == bin(i).count("1")
        for t in family.tables.values():  # merged, not strung together
            assert spark.table(t).count() == spark.table(t).select("key", "region").distinct().count()
    for plan in (family._scanned(family.tables[0]), family.repeated()):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    family.drop_levels()
    got = {tuple(r) for r in family.repeated().collect()}
    family.drop()
    total = {}
    for key, region, n in (x for part in parts for x in part):
        total.setdefault(key, {}).setdefault(region, 0)
        total[key][region] += n
    assert got == {(key, r, n, len(of), len(of) > 1 and min(of.values()) == 1)
                   for key, of in total.items() if sum(of.values()) > 1 for r, n in of.items()}


def test_pieces(spark, monkeypatch):
    """Long texts are looked at piece by piece."""
    raw = corpus()[7].encode() * 2
    whole = suffix.entries_of([raw])[0]
    monkeypatch.setattr(suffix, "PIECE", 500)
    for key, region, start, count in zip(*suffix.entries_of([b"x", raw, b""])[1]):
        assert count > 0 and start + count + suffix.MATCH - 1 <= len(raw)
    assert sum(suffix.entries_of([raw])[0][3]) == sum(whole[3]) == len(raw) - suffix.MATCH + 1


def test_any_doc_id_and_no_table_left(spark, monkeypatch):
    """The smallest number is a doc_id like others, also beside null; a failed batch leaves no table."""
    text = corpus()[7]
    docs = spark.createDataFrame([(None, text), (suffix.NULL_ID, text), (suffix.NULL_ID, "b"), (None, None)], "doc_id long, text string")
    before = {t.name for t in spark.catalog.listTables()}
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in suffix.digests(*suffix.remove_repeats(docs)).collect()}
    n = len(text.encode())
    assert got == {(None, n, n), (suffix.NULL_ID, n, n), (suffix.NULL_ID, 1, 0), (None, 0, 0)}

    def failed(self, new):
        raise ValueError("lost")

    monkeypatch.setattr(suffix.Family, "_scanned", failed)
    with pytest.raises(ValueError):
        suffix.remove_repeats(docs)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.digests(*suffix.remove_repeats(none)).collect() == []
