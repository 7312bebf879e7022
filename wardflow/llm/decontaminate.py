"""Benchmark passages in documents, found by edit distance over words.

Windows of an item's length are embedded by random walks (CGK): two sequences of small edit
distance get embeddings of small Hamming distance. Keys of sampled places of the embedding are
compared with those of the items, repeated until a pair within the distance meets with the target
recall; pairs that meet are verified by their exact edit distance.

Only windows that can match are embedded: a window within k word edits of an item of L words
shares at least L - 2 - 3k of its word triples (3 words are touched by no more than 3 triples),
so windows with fewer are left out without loss.

Items are a stated query set. They go to the tasks in blocks of bounded size; documents are
never shuffled.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches

RATE = 0.15          # word edits per word of an item
RECALL = 0.995       # that a pair within the distance meets in some repetition
PLACES = 2           # sampled places of an embedding in a key
#: Least share of embedding places in which two sequences within the distance agree; measured,
#: see the tests.
AGREE = 0.3
ITEM_BLOCK = 20_000  # items that go to the tasks at once
SEED = 11
WINDOWS = 2048       # windows that are embedded at once

WORD = re.compile(r"\w+")
_GRAM = 3


def words_of(text: str) -> list[str]:
    """Words in lower case without punctuation."""
    return WORD.findall(text.lower())


def edits_allowed(n_words: int) -> int:
    return int(RATE * n_words)


def repetitions() -> int:
    return math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE ** PLACES))


def _bits(step: int, symbols: np.ndarray) -> np.ndarray:
    """A random bit for each repetition (row), step and symbol."""
    rep = np.arange(len(symbols), dtype=np.uint64)[:, None]
    x = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (rep << np.uint64(20)) + np.uint64(step)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(40) & np.uint64(1)).astype(np.int64)


def keys_of(windows: np.ndarray) -> np.ndarray:
    """For each repetition and row of `windows` the symbols at the sampled places of its
    random-walk embedding: the walk stays at a symbol or goes on by a random bit of repetition,
    step and symbol; past the end it is 0."""
    n = windows.shape[1]
    reps, steps = repetitions(), 2 * n
    rng = np.random.default_rng([SEED, n])
    places = np.stack([rng.choice(steps, size=min(PLACES, steps), replace=False) for _ in range(reps)])
    padded = np.concatenate([windows, np.zeros((len(windows), 1), windows.dtype)], axis=1)
    rows = np.arange(len(windows))[None, :]
    at = np.zeros((reps, len(windows)), dtype=np.int64)
    out = np.zeros((reps, len(windows), places.shape[1]), dtype=np.int64)
    for step in range(steps):
        symbols = padded[rows, at]
        for rep, k in np.argwhere(places == step):
            out[rep, :, k] = symbols[rep]
        at = np.minimum(n, at + _bits(step, symbols))
    return out


def edit_span(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of `item` to a part of `text`, with that part's start and end (the
    first such end, and the shortest part)."""
    dist = np.arange(len(item) + 1)
    begin = np.zeros(len(item) + 1, dtype=np.int64)
    best = (int(dist[-1]), 0, 0)
    for j, symbol in enumerate(text.tolist()):
        new, frm = [0], [j + 1]
        for i in range(1, len(item) + 1):
            options = ((dist[i - 1] + (item[i - 1] != symbol), -begin[i - 1]), (new[i - 1] + 1, -frm[i - 1]),
                       (dist[i] + 1, -begin[i]))
            d, b = min(options)
            new.append(int(d))
            frm.append(int(-b))
        dist, begin = new, frm
        if dist[-1] < best[0]:
            best = (int(dist[-1]), int(begin[-1]), j + 1)
    return best


def _window(ids: np.ndarray, start: int, n: int) -> np.ndarray:
    """Words from `start` on; 0 beyond the text."""
    out = np.zeros(n, dtype=np.int64)
    part = ids[max(0, start):max(0, start + n)]
    first = max(0, -start)
    out[first:first + len(part)] = part
    return out


class Items:
    """The items of one block, ready for search."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.words = [], []
        for item_id, text in items:
            w = words_of(text or "")
            if w:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], dtype=np.int64))
        self.base = len(self.vocabulary) + 1
        grams = defaultdict(list)
        for t, w in enumerate(self.words):
            for i, g in enumerate(self.grams(w, min(_GRAM, len(w))).tolist()):
                grams[min(_GRAM, len(w)), g].append((t, i))
        self.by_size = {}
        for q in {q for q, _ in grams}:
            mine = sorted((g, where) for (p, g), where in grams.items() if p == q)
            flat = [x for _, where in mine for x in where]
            ends = np.cumsum([len(where) for _, where in mine])
            self.by_size[q] = (np.array([g for g, _ in mine]), ends, np.array(flat, dtype=np.int64).reshape(-1, 2))
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.allowed = np.array([edits_allowed(n) for n in self.length.tolist()], dtype=np.int64)
        q = np.minimum(_GRAM, self.length)
        self.shared = np.maximum(1, self.length - q + 1 - q * self.allowed)
        self.of_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in set(self.length.tolist()):
            which = np.flatnonzero(self.length == n)
            self.of_length[n] = which, np.stack([self.words[t] for t in which])
        self._keys: dict[int, dict[tuple, list[int]]] = {}

    def grams(self, ids: np.ndarray, q: int) -> np.ndarray:
        """Numbers for the runs of q words; runs with an unknown word give -1."""
        n = len(ids) - q + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        out, known = np.zeros(n, dtype=np.int64), np.ones(n, bool)
        for k in range(q):  # up to 2 million different words fit
            out = out * self.base + ids[k:k + n]
            known &= ids[k:k + n] > 0
        return np.where(known, out, -1)

    def _item_keys(self, n: int) -> dict[tuple, list[int]]:
        if n not in self._keys:
            which, words = self.of_length[n]
            self._keys[n] = defaultdict(list)
            for rep, keys in enumerate(keys_of(words).tolist()):
                for t, key in zip(which.tolist(), keys):
                    if all(key):  # past the end all agree, which says nothing
                        self._keys[n][rep, *key].append(t)
        return self._keys[n]

    def windows(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(start, length) of the windows with enough triples of an item of that length."""
        out = set()
        for q, (grams, ends, where) in self.by_size.items():
            g = self.grams(ids, q)
            j = np.flatnonzero(g >= 0)
            at = np.minimum(np.searchsorted(grams, g[j]), len(grams) - 1)
            hit = grams[at] == g[j]
            j, at = j[hit], at[hit]
            if not len(j):
                continue
            first = np.concatenate([[0], ends[:-1]])[at]
            n = ends[at] - first
            pick = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            j, (t, i) = np.repeat(j, n), where[pick].T
            many = np.bincount(t, minlength=len(self.words)) >= self.shared
            for item in np.flatnonzero(many & (np.bincount(t, minlength=len(self.words)) > 0)).tolist():
                mine = j[t == item]
                starts = np.unique(mine - i[t == item])
                k, size = self.allowed[item], self.length[item]
                inside = np.searchsorted(mine, starts + size + k) - np.searchsorted(mine, starts - k)
                out |= {(int(s), int(size)) for s in starts[inside >= self.shared[item]]}
        return out

    def _common(self, t: int, part: np.ndarray) -> int:
        mine, n = np.unique(self.words[t], return_counts=True)
        return int(np.minimum(n, (part[:, None] == mine).sum(axis=0)).sum())

    def search(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
        """For each text, given by word numbers, (item, first word, end word, edits) of its
        passages; of those of one item that overlap, the one with the fewest edits."""
        by_length = defaultdict(list)
        for d, ids in enumerate(texts):
            for s, n in sorted(self.windows(ids)):
                by_length[n].append((d, s))
        met: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for n, where in by_length.items():
            known = self._item_keys(n)
            for i in range(0, len(where), WINDOWS):
                some = where[i:i + WINDOWS]
                for rep, keys in enumerate(keys_of(np.stack([_window(texts[d], s, n) for d, s in some])).tolist()):
                    for (d, s), key in zip(some, keys):
                        for t in known.get((rep, *key), ()):
                            met[d].add((t, s))
        return [self._verified(ids, met[d]) if d in met else [] for d, ids in enumerate(texts)]

    def _verified(self, ids: np.ndarray, met: set[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        same = {(t, s) for t, s in met if s >= 0 and np.array_equal(ids[s:s + self.length[t]], self.words[t])}
        found = [(0, s, s + int(self.length[t]), t) for t, s in same]
        exact = defaultdict(list)
        for t, s in same:
            exact[t].append(s)
        for t, s in met - same:
            k, n = int(self.allowed[t]), int(self.length[t])
            if any(abs(s - x) <= k for x in exact[t]):
                continue  # the same passage, a few words off
            low = max(0, s - k)
            part = ids[low:max(0, s + n + k)]
            if self._common(t, part) < n - k:
                continue  # each word that the part lacks costs an edit
            d, b, e = edit_span(self.words[t], part)
            if d <= k and e > b:
                found.append((d, low + b, low + e, t))
        out: list[tuple[int, int, int, int]] = []
        for d, b, e, t in sorted(set(found)):
            if not any(t == x and b < y and z < e for x, z, y, _ in out):
                out.append((t, b, e, d))
        return sorted(out)


def _search_block(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    schema = "_id long, _th long, item_id long, start int, end int, n_words int, edits int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(items)
        get = known.vocabulary.get
        for batch in batches:
            out = []
            texts = batch.column("text").to_pylist()
            ids = [np.array([get(w, 0) for w in WORD.findall(x.lower())], dtype=np.int64) for x in texts]
            for row, found in enumerate(known.search(ids)):
                if found:
                    text, low = texts[row], texts[row].lower()
                    # Lower case may change the length of a text; then words are found in the text itself.
                    spans = [m.span() for m in WORD.finditer(low if len(low) == len(text) else text)]
                    exact = len(spans) == len(ids[row])
                    for t, b, e, d in found:
                        out.append((row, known.ids[t], spans[b][0] if exact else None, spans[e - 1][1] if exact else None,
                                    int(known.length[t]), d))
            rows = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "_id": batch.column("_id").take(rows), "_th": batch.column("_th").take(rows),
                **{c: pa.array([x[k] for x in out], kind) for k, (c, kind) in enumerate(
                    (("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32()), ("edits", pa.int32())), 1)}})

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_th"),
                       text.alias("text")).mapInArrow(work, schema)


def find_passages(docs: DataFrame, items: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """One row per passage of `docs(doc_id, text)` within RATE word edits per word of an item of
    `items(item_id, text)`: `_id, _th` (the document), item_id, start and end in code points,
    n_words of the item, edits.

    Words are compared in lower case and without punctuation. Null and empty texts, and items
    without words, match nothing; equal rows give equal rows, a null doc_id stays null; equal
    items each give their rows. Where lower case changes the number of words, start and end are
    null. An empty table gives no rows. Other columns are not read. Items are searched `block`
    at a time, each time in one pass over the documents.
    """
    bounded_batches(docs.sparkSession)
    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = max(1, -(-chosen.count() // block))
    parts = []
    for b in range(n):
        some = chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else chosen
        parts.append(_search_block(docs, [(r.item_id, r.text) for r in some.collect()]))
    return reduce(DataFrame.union, parts)
