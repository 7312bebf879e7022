"""Phrases of two to four words that stand together more often than their parts alone.

Top-order marginalisation: each word opens one window, itself and the next three words of its piece
as lead columns, padded at the end of the piece. Only these longest windows are counted; ROLLUP
over their columns sums them up to all shorter phrases, as a phrase's count is the sum over the
windows that begin with it.

Before the ROLLUP the windows meet by their first words, in buckets: windows combined in a task travel
as compressed blocks, and a bucket cuts from each window the words after its longest prefix with
enough occurrences. What is cut can belong to no candidate and no part of one, so what
ROLLUP sees is exact for all that count, and small. First words so frequent that a bucket would not
hold them are known beforehand, and their windows are dealt by one word more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, stored

ORDER = 4                # words of the longest phrase
LEAST = 30               # occurrences of a candidate
COVERED_PERCENT = 80     # of a phrase's occurrences inside a longer candidate, from which it goes
SCALE = 2_000_000
TOP = 2000               # phrases of a language in the report
NO_LANG = "und"

SEGMENT = 4_000_000      # characters whose windows are combined at once
BUCKET = 1_500_000       # windows of a bucket, about
HEAVY = 20_000           # prefixes with more than this part of all windows are dealt by a further word

# Ends of pieces. Fixed values.
_DELIMITERS = ".,;:!?\n\x0b\x0c\r"
_END = re.compile(f"[{_DELIMITERS}]")
# Bytes of UTF-8 after lower-casing A-Z: white space is a space, an end of a piece a new line.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[9] = 32
_BYTES[[ord(c) for c in _DELIMITERS]] = 10

_BLOCK = "bucket int, lang string, words binary, sizes binary, counts binary, depths binary"
_COLUMNS = tuple(f"w{k}" for k in range(1, ORDER + 1))


class Windows(NamedTuple):
    """Windows of one segment: ids (from 1, 0 pads) into `words`, one row per occurrence."""

    words: pa.StringArray
    ids: np.ndarray


def _segments(texts: list[str]) -> Iterator[str]:
    """The texts by new lines, cut at ends of pieces into strings of about SEGMENT characters."""
    held, size = [], 0
    for text in texts:
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > SEGMENT and (found := _END.search(text, at + SEGMENT)):
                end = found.end()
            if size + end - at > SEGMENT and held:
                yield "\n".join(held)
                held, size = [], 0
            held.append(text[at:end] if at or end < len(text) else text)
            size += end - at
            at = end
    if held:
        yield "\n".join(held)


def windows(text: str) -> Windows:
    """The padded longest windows of a text."""
    data = _BYTES[np.frombuffer(text.encode(), np.uint8)]
    apart = (data == 32) | (data == 10)
    before = np.concatenate([[True], apart[:-1]])
    starts = np.flatnonzero(~apart & before)
    if not len(starts):
        return Windows(pa.array([], pa.string()), np.zeros((0, ORDER), dtype=np.int64))
    ends = np.flatnonzero(apart & ~before)
    sizes = (ends if len(ends) == len(starts) else np.append(ends, len(data))) - starts
    piece = np.cumsum(data == 10, dtype=np.int32)[starts]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[~apart])).dictionary_encode()
    ids = np.zeros((len(starts), ORDER), dtype=np.int64)
    ids[:, 0] = found.indices.to_numpy() + 1
    for k in range(1, min(ORDER, len(starts))):
        # The lead column, within the piece.
        ids[:-k, k] = np.where(piece[k:] == piece[:-k], ids[k:, 0], 0)
    return Windows(found.dictionary, ids)


def _sorted(ids: np.ndarray, n_ids: int, first: np.ndarray | None = None) -> np.ndarray:
    """The order by `first`, then by the columns of `ids`."""
    high, low = ids[:, 0] * n_ids + ids[:, 1], ids[:, 2] * n_ids + ids[:, 3]
    if first is None:
        return np.lexsort((low, high))
    if (int(first.max(initial=0)) + 1) * n_ids * n_ids < 1 << 62:
        return np.lexsort((low, first * (n_ids * n_ids) + high))
    return np.lexsort((low, high, first))


def _groups(ids: np.ndarray, depth: int) -> np.ndarray:
    """Where a new prefix of `depth` words begins in sorted ids."""
    if not len(ids):
        return np.zeros(0, dtype=np.int64)
    new = (ids[1:, :depth] != ids[:-1, :depth]).any(axis=1)
    return np.flatnonzero(np.concatenate([[True], new]))


def _joined(words: pa.StringArray, ids: np.ndarray) -> pa.StringArray:
    """Windows as text, words with a space between; `ids` may have any number of columns."""
    columns = [words.take(pa.array(ids[:, k] - 1, mask=ids[:, k] == 0)) for k in range(ids.shape[1])]
    return pc.binary_join_element_wise(*columns, " ", null_handling="skip")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    of: dict[str, list[str]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        if text:
            of.setdefault(lang, []).append(text)
    for lang, texts in of.items():
        for segment in _segments(texts):
            yield lang, segment


def heavy_prefixes(docs: DataFrame) -> tuple[int, list[tuple[str, str, int]]]:
    """The number of windows, and (lang, prefix, words) of prefixes with over 1 / HEAVY of them.

    A segment names prefixes with that part of its own windows, so the list is at most ORDER - 1
    times HEAVY long however large the corpus, and each prefix on it has LEAST occurrences at least.
    One that is missed costs time, not results.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, segment in _by_lang(batch):
                words, ids = windows(segment)
                ids = ids[_sorted(ids, len(words) + 1)]
                prefixes, depths, counts = [pa.array([""])], [np.zeros(1, dtype=np.int32)], [np.array([len(ids)])]
                for depth in range(1, ORDER):
                    at = _groups(ids, depth)
                    n = np.diff(np.append(at, len(ids)))
                    chosen = (n * HEAVY > len(ids)) & (ids[at, depth - 1] > 0)
                    prefixes.append(_joined(words, ids[at[chosen], :depth]))
                    counts.append(n[chosen])
                    depths.append(np.full(chosen.sum(), depth, dtype=np.int32))
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * sum(map(len, counts)), pa.string()),
                    "prefix": pa.concat_arrays(prefixes), "depth": pa.array(np.concatenate(depths)),
                    "n": pa.array(np.concatenate(counts).astype(np.int64))})

    found = stored(docs.mapInArrow(work, "lang string, prefix string, depth int, n long")
                   .groupBy("lang", "prefix", "depth").agg(F.sum("n").alias("n")))
    total = found.where("depth = 0").agg(F.sum("n")).first()[0] or 0
    heavy = found.where((F.col("depth") > 0) & (F.col("n") >= LEAST) & (F.col("n") * HEAVY > total))
    return total, [(r.lang, r.prefix, r.depth) for r in heavy.collect()]


def _dealt(lang: str, found: Windows, heavy: dict[int, list[str]], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and heavy depth of each window: it is dealt by its heavy prefix and one word more."""
    words, ids = found
    n_ids = len(words) + 1
    depth = np.zeros(len(ids), dtype=np.int8)
    code, alive = np.zeros(len(ids), dtype=np.int64), np.ones(len(ids), dtype=bool)
    index = {"": 0}
    for k in range(1, ORDER):
        parts = [p.rpartition(" ") for p in heavy.get(k, ())]
        if not parts:
            break
        last = pc.index_in(pa.array([p[2] for p in parts], pa.string()), words).to_pylist()
        known = [(index[p[0]] * n_ids + i + 1, " ".join(filter(None, (p[0], p[2]))))
                 for p, i in zip(parts, last) if i is not None and p[0] in index]
        known.sort()
        codes = np.array([c for c, _ in known], dtype=np.int64)
        index = {prefix: i for i, (_, prefix) in enumerate(known)}
        if not len(codes):
            break
        code = code * n_ids + ids[:, k - 1]
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        alive &= codes[at] == code
        depth[alive] = k
        code = at
    hashes = np.array([0, *(xxhash.xxh64_intdigest(w) for w in words.to_pylist())], dtype=np.uint64)
    mixed = np.full(len(ids), xxhash.xxh64_intdigest(lang), dtype=np.uint64)
    key = mixed
    for k in range(ORDER):
        mixed = (mixed ^ hashes[ids[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = np.where(depth == k, mixed, key)
    return (key % np.uint64(n_buckets)).astype(np.int64), depth


def _zip(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes())


def _unzip(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def window_blocks(docs: DataFrame, heavy: list[tuple[str, str, int]], n_buckets: int) -> DataFrame:
    """The windows, combined within a segment, as one block per language and bucket."""
    of: dict[str, dict[int, list[str]]] = {}
    for lang, prefix, depth in heavy:
        of.setdefault(lang, {}).setdefault(depth, []).append(prefix)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, segment in _by_lang(batch):
                found = windows(segment)
                words, ids = found
                bucket, depth = _dealt(lang, found, of.get(lang, {}), n_buckets)
                order = _sorted(ids, len(words) + 1, bucket)
                ids, bucket, depth = ids[order], bucket[order], depth[order]
                at = _groups(ids, ORDER)  # a window has one bucket
                n = np.diff(np.append(at, len(ids))).astype("<i4")
                ids, bucket, depth = ids[at], bucket[at], depth[at]
                text = _joined(words, ids)
                offsets = np.frombuffer(text.buffers()[1], np.int32)[:len(text) + 1] if len(text) else np.zeros(1, np.int32)
                data = memoryview(text.buffers()[2] or b"")
                begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
                rows = {"bucket": [], "words": [], "sizes": [], "counts": [], "depths": []}
                for i, j in zip(begin, np.append(begin, len(bucket))[1:]):
                    rows["bucket"].append(int(bucket[i]))
                    rows["words"].append(_zip(bytes(data[offsets[i]:offsets[j]])))
                    rows["sizes"].append(_zip(np.diff(offsets[i:j + 1]).astype("<i4")))
                    rows["counts"].append(_zip(n[i:j]))
                    rows["depths"].append(_zip(depth[i:j]))
                if rows["bucket"]:
                    yield pa.RecordBatch.from_pydict({
                        "bucket": pa.array(rows["bucket"], pa.int32()), "lang": pa.array([lang] * len(rows["bucket"]), pa.string()),
                        **{c: pa.array(rows[c], pa.binary()) for c in ("words", "sizes", "counts", "depths")}})

    return docs.mapInArrow(work, _BLOCK)


def _pruned(lang: str, blocks: list[dict]) -> pa.RecordBatch:
    """The windows of one language and bucket, cut after their longest prefix with enough occurrences."""
    data = b"".join(zstandard.ZstdDecompressor().decompress(b["words"]) for b in blocks)
    sizes = np.concatenate([_unzip(b["sizes"], "<i4") for b in blocks])
    counts = np.concatenate([_unzip(b["counts"], "<i4") for b in blocks]).astype(np.int64)
    depth = np.concatenate([_unzip(b["depths"], "i1") for b in blocks])
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    # Words stand at single spaces within a window.
    raw = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(raw == 32)
    cuts = np.sort(np.concatenate([offsets[:-1], spaces]))
    n_words = np.diff(np.concatenate([np.searchsorted(cuts, offsets[:-1]), [len(cuts)]]))
    ends = np.append(cuts[1:], len(raw))
    is_space = np.zeros(len(cuts), dtype=bool)
    is_space[np.searchsorted(cuts, spaces)] = True
    word_offsets = np.concatenate([[0], np.cumsum(ends - cuts - is_space)]).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(
        len(cuts), pa.py_buffer(word_offsets), pa.py_buffer(raw[raw != 32])).dictionary_encode()
    ids = np.zeros((len(sizes), ORDER), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), n_words)
    ids[row, np.arange(len(cuts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)] = found.indices.to_numpy() + 1

    n_ids = len(found.dictionary) + 1
    order = _sorted(ids, n_ids)
    ids, counts, depth = ids[order], counts[order], depth[order].astype(np.int64)
    group = np.zeros((ORDER + 1, len(ids)), dtype=np.int64)
    for k in range(1, ORDER + 1):
        at = _groups(ids, k)
        size = np.diff(np.append(at, len(ids)))
        enough = np.repeat(np.add.reduceat(counts, at) >= LEAST, size) & (ids[:, k - 1] > 0)
        # Up to the heavy depth the sums of a bucket are not whole, and known to be enough.
        depth = np.where(enough & (depth == k - 1), k, depth)
        group[k] = np.repeat(at, size)
    key, first, where = np.unique(depth * len(ids) + group[depth, np.arange(len(ids))], return_index=True, return_inverse=True)
    n = np.zeros(len(key), dtype=np.int64)
    np.add.at(n, where, counts)
    cut = np.where(np.arange(ORDER)[None, :] < depth[first][:, None], ids[first], 0)
    words = found.dictionary.cast(pa.string())
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * len(n), pa.string()),
        **{c: words.take(pa.array(cut[:, k] - 1, mask=cut[:, k] == 0)) for k, c in enumerate(_COLUMNS)},
        "n": pa.array(n)})


def pruned_windows(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """`lang, w1 ... w4, n`: the windows of all buckets, cut; one bucket is held at a time."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["bucket"], r["lang"]) != now and held:
                    yield _pruned(now[1], held)
                    held = []
                now = r["bucket"], r["lang"]
                held.append(r)
        if held:
            yield _pruned(now[1], held)

    return (blocks.repartitionById(n_buckets, "bucket").sortWithinPartitions("bucket", "lang")
            .mapInArrow(work, f"lang string, {', '.join(f'{c} string' for c in _COLUMNS)}, n long"))


def phrase_counts(docs: DataFrame) -> DataFrame:
    """`lang, n_words, phrase, f` of all phrases of up to four words with LEAST occurrences in
    `docs(lang, text)`; the row with no words has the number of all words of the language."""
    bounded_batches(docs.sparkSession)
    chosen = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                         F.col("text").cast("string").alias("text"))
    total, heavy = heavy_prefixes(chosen)
    n_buckets = max(1, -(-total // BUCKET))
    cut = pruned_windows(window_blocks(chosen, heavy, n_buckets), n_buckets)
    summed = stored(cut.rollup("lang", *_COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level")))
    # Of each level of the ROLLUP the rows whose last word is no padding.
    last = F.coalesce(*[F.when((F.col("level") == 2 ** (ORDER - k) - 1) & F.col(_COLUMNS[k - 1]).isNotNull(), F.lit(k))
                        for k in range(1, ORDER + 1)], F.when(F.col("level") == 2**ORDER - 1, F.lit(0)))
    return (summed.withColumn("n_words", last)
            .where((F.col("n_words") == 0) | (F.col("f") >= LEAST))
            .select("lang", "n_words", F.concat_ws(" ", *_COLUMNS).alias("phrase"), "f"))


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def mine_phrases(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Per language (null: und) of `docs(lang, text)` the first `top` phrases by score, then count,
    then UTF-8 bytes: `lang, rank, phrase, a, l, r, n, score`.

    `a` is the phrase's count and `n` that of all words of the language; `l` and `r` are the counts
    of its parts at the cut with the lowest score, 2,000,000 a / (l + r) rounded down (the first such
    cut). Phrases with four fifths of their occurrences inside a longer candidate are left out. A null
    or empty text has no words; rows that repeat count again; an empty table, or one without candidates,
    gives no rows. A text of any length is read whole, by segments. Other columns are not read.
    """
    counts = stored(phrase_counts(docs))
    words = F.split("phrase", " ")
    candidates = counts.where("n_words > 1").select("lang", "phrase", F.col("f").alias("a"), "n_words", words.alias("_words"))

    def joined(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("_words", start, size), " ")

    cuts = (candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("_l"),
                    joined(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("_r")))
    parts = counts.where("n_words > 0")
    left = parts.select("lang", F.col("phrase").alias("_l"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("_r"), F.col("f").alias("r"))
    scored = (cuts.join(left, ["lang", "_l"]).join(right, ["lang", "_r"])
              .withColumn("_a", _exact(F.col("a"))).withColumn("_parts", _exact(F.col("l")) + _exact(F.col("r")))
              .withColumn("score", F.expr(f"cast({SCALE} as decimal(7,0)) * _a div _parts"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    # Every phrase inside a candidate, with the highest count of such a candidate.
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - size + 1), lambda i: joined(i, size))))
    covered = (candidates.where("n_words > 2").select("lang", F.explode(inside).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    free = scored.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull()
        | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * COVERED_PERCENT))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    n = counts.where("n_words = 0").select("lang", F.col("f").alias("n"))
    return (free.withColumn("rank", rank).where(F.col("rank") <= top).join(n, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                    F.col("cut.score").cast("long").alias("score")))
