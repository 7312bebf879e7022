"""Exact repeats of long byte strings, by a logarithmic family of sorted suffix indexes.

Not every suffix is indexed. Each window of MATCH bytes picks the place in it whose following
GRAM bytes have the least hash; equal windows pick the same place. A place and the windows that
pick it make one entry: `key`, the hash of the suffix's first bytes, and `region`, the hash of all
bytes of its windows. So a repeat of MATCH bytes meets its equal at an entry of the same key.

Batches of documents get an index of their entries, sorted by key and region in hash buckets. A
new index is scanned together with the levels that are there, bucket by bucket without a shuffle,
and the keys that it has in common with them, or twice itself, are recorded as matches; levels are
read for nothing else. Then indexes of equal rank are merged into one of the next rank, so a family
has few indexes and an entry is rewritten a logarithmic number of times. Of a key that matched,
entries of equal region repeat as a whole; of the others the bytes are fetched and their windows
compared one by one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, once, stored

MATCH = 200          # bytes of a repeat
GRAM = 48            # bytes that place and key look at
PIECE = 1 << 20      # window starts that are looked at together
BATCHES = 4          # indexes that a whole table is added by
NULL_ID = -(1 << 63)  # stands for a null doc_id where rows are joined
WIDE = 5_000         # regions of one key that one task compares
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_PLACE_BITS = 22
_MASK = np.uint64((1 << _PLACE_BITS) - 1)


def _powers(base: int) -> np.ndarray:
    return once(("powers",), lambda: {x: _cumulative(x) for x in (_R, _R_INVERSE)})[base]


def _cumulative(base: int) -> np.ndarray:
    p = np.full(2 * PIECE + 4 * MATCH, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def run_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the `n` bytes from each place on, whatever stands before."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_R)[:len(data)],
                                                             dtype=np.uint64)])
    return _mix((sums[n:] - sums[:-n]) * _powers(_R_INVERSE)[:len(data) - n + 1])


def picked(hashes: np.ndarray) -> np.ndarray:
    """For each window of MATCH bytes the place in it with the least hash, the first of equals."""
    width = MATCH - GRAM + 1
    keyed = (hashes & ~_MASK) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.full(-(-len(keyed) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:len(keyed)] = keyed
    blocks = blocks.reshape(-1, width)
    up_to = np.minimum.accumulate(blocks, axis=1).ravel()
    from_on = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(hashes) - width + 1
    return (np.minimum(from_on[:n], up_to[width - 1:width - 1 + n]) & _MASK).astype(np.int64)


def entries_of(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its entries: key, region, first window and number of windows."""
    out: list[list[tuple]] = [[] for _ in texts]
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        data = b"".join(p for _, _, p in held)
        array = np.frombuffer(data, np.uint8)
        hashes = run_hashes(array, GRAM)
        place = picked(hashes)
        new = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        edges = np.cumsum([0] + [len(p) for _, _, p in held])
        # A run of windows ends where a text ends: those over the border belong to none.
        first_of, last_of = edges[:-1], edges[1:] - MATCH
        starts = np.unique(np.concatenate([new, first_of]))
        ends = np.append(starts[1:], len(place)) - 1
        text = np.searchsorted(edges, starts, side="right") - 1
        ends = np.minimum(ends, last_of[text])
        real = starts <= ends
        starts, ends, text = starts[real], ends[real], text[real]
        view = memoryview(data)
        digest = xxhash.xxh3_64_intdigest
        regions = np.array([digest(view[s:e]) for s, e in zip(starts.tolist(), (ends + MATCH).tolist())], dtype=np.uint64)
        keys = hashes[place[starts]]
        cut = np.searchsorted(text, np.arange(len(held) + 1))
        for i, (t, offset, _) in enumerate(held):
            a, b = cut[i], cut[i + 1]
            out[t].append((keys[a:b], regions[a:b], starts[a:b] - edges[i] + offset, ends[a:b] - starts[a:b] + 1))

    for t, raw in enumerate(texts):
        for offset in range(0, max(0, len(raw) - MATCH + 1), PIECE):
            part = raw[offset:offset + PIECE + MATCH - 1]
            if held and size + len(part) > PIECE + MATCH:
                flush()
                held, size = [], 0
            held.append((t, offset, part))
            size += len(part)
    if held:
        flush()
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return [tuple(np.concatenate(x) for x in zip(*parts)) if parts else none for parts in out]


def suffixes(docs: DataFrame) -> DataFrame:
    """One row per document: `_n` (its number), `_d, _null` (whether it has no doc_id), `_th, n_bytes,
    sha` and the lists `keys, regions, starts, counts`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found = entries_of(texts)
            yield pa.RecordBatch.from_pydict({
                "_n": batch.column("_n"), "_d": batch.column("_d"), "_null": batch.column("_null"), "_th": batch.column("_th"),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "sha": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                "keys": pa.array([x[0].view(np.int64) for x in found], pa.list_(pa.int64())),
                "regions": pa.array([x[1].view(np.int64) for x in found], pa.list_(pa.int64())),
                "starts": pa.array([x[2].astype(np.int32) for x in found], pa.list_(pa.int32())),
                "counts": pa.array([x[3].astype(np.int32) for x in found], pa.list_(pa.int32()))})

    numbered = _texts(docs, F.col("doc_id").isNull().alias("_null")).withColumn("_n", F.monotonically_increasing_id())
    return numbered.mapInArrow(work, "_n long, _d long, _null boolean, _th string, n_bytes long, sha string, keys array<long>, "
                                     "regions array<long>, starts array<int>, counts array<int>")


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    """`_d, _th, text`: a doc_id that is never null, a hash that stands for the text, the text; and `more`."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_d"), F.md5(text).alias("_th"),
                       text.alias("text"), *more)


def _combined(rows: DataFrame) -> DataFrame:
    """`key, region, n` of the entries of some documents, equal ones of a batch already counted."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, regions = (batch.column(c).flatten().to_numpy() for c in ("keys", "regions"))
            order = np.lexsort((regions, keys))
            keys, regions = keys[order], regions[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (regions[1:] != regions[:-1])])[:len(keys)])
            yield pa.RecordBatch.from_pydict({"key": keys[first], "region": regions[first],
                                              "n": np.diff(np.append(first, len(keys)))})

    return rows.select("keys", "regions").mapInArrow(work, "key long, region long, n long")


class Family:
    """Sorted indexes by rank, at most one of each, and the matches found when each batch was
    added: tables `key, region, n, batch` in hash buckets, `batch` the last one with the entry."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.added = 0
        self.tables: dict[int, str] = {}
        self.matches: list[str] = []
        self.written: list[str] = []

    def _written(self, entries: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        self.written.append(name)
        entries.write.bucketBy(self.buckets, "key").sortBy("key", "region").saveAsTable(name)
        return name

    def add(self, entries: DataFrame) -> None:
        """Adds a batch of `key, region, n`: records its matches, then equal ranks merge until each is there once."""
        self.added += 1
        now = self._written(entries.repartition(self.buckets, "key").groupBy("key", "region").agg(
            F.sum("n").alias("n"), F.lit(self.added).alias("batch")))
        self.matches.append(self._written(self._scanned(now)))
        rank = 0
        while rank in self.tables:
            other = self.tables.pop(rank)
            merged = self._written(self._together([now, other]))
            for name in (now, other):
                self.spark.sql(f"DROP TABLE {name}")
                self.written.remove(name)
            now, rank = merged, rank + 1
        self.tables[rank] = now

    def _united(self, names: list[str]) -> DataFrame:
        """Tables of the same buckets, united bucket by bucket without a shuffle. The filter holds
        for all rows: a union of bare Parquet scans works on column batches and would string the
        buckets together instead, although the plan counts on them."""
        return reduce(DataFrame.union, [self.spark.table(t).where(F.col("n") > 0) for t in names])

    def _together(self, names: list[str]) -> DataFrame:
        """The entries of some indexes, scanned together and summed."""
        return self._united(names).groupBy("key", "region").agg(
            F.sum("n").alias("n"), F.max("batch").alias("batch"))

    def _scanned(self, new: str) -> DataFrame:
        """A new index scanned together with all levels: the keys that it has and that occur more
        than once so far, each with all its regions and their numbers so far."""
        of_key = W.partitionBy("key")
        return (self._together([new, *self.tables.values()])
                .select("*", F.sum("n").over(of_key).alias("_total"), F.max("batch").over(of_key).alias("_last"))
                .where((F.col("_total") > 1) & (F.col("_last") == self.added)).drop("_total", "_last"))

    def repeated(self) -> DataFrame:
        """The matches of all batches: `key, region, n`, with `open`: whether some region of the key
        occurs once only, and `k`, the key's regions. The batch that had a key last recorded all its
        regions with their final numbers, the largest."""
        of_key = W.partitionBy("key")
        return (self._united(self.matches).groupBy("key", "region").agg(F.max("n").alias("n"))
                .select("key", "region", "n", F.count(F.lit(1)).over(of_key).alias("k"), F.min("n").over(of_key).alias("_least"))
                .select("key", "region", "n", "k", ((F.col("k") > 1) & (F.col("_least") == 1)).alias("open")))

    def drop_levels(self) -> None:
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.popitem()[1]}")

    def drop(self) -> None:
        """Drops all that was written, also what a failed batch left behind."""
        self.drop_levels()
        while self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.written.pop()}")


def _exploded(rows: DataFrame) -> DataFrame:
    return rows.select("_n", F.explode(F.arrays_zip("keys", "regions", "starts", "counts")).alias("e")).select(
        "_n", F.col("e.keys").alias("key"), F.col("e.regions").alias("region"),
        F.col("e.starts").alias("start"), F.col("e.counts").alias("count"))


def _windows(regions: DataFrame) -> DataFrame:
    """Of `key, _d, _th, start, single, bytes` sorted by key in each partition: runs of windows
    of single regions that another region of the key has too, as `_d, _th, start, count`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            # A key's regions stay together: all up to the last key change are done.
            if sum(b.nbytes for b in held) > 8 << 20:
                t = pa.Table.from_batches(held).combine_chunks()
                keys = t["key"].to_numpy()
                last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                if last:
                    yield from _compared(t.slice(0, last))
                held = t.slice(last).to_batches()
        if held:
            yield from _compared(pa.Table.from_batches(held))

    return regions.mapInArrow(work, "_d long, _th string, start int, count int")


def _compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
    n = np.array([len(x) - MATCH + 1 for x in t["bytes"].to_pylist()], dtype=np.int64)
    of = np.repeat(np.arange(len(n)), n)
    both = _hash_windows(t["bytes"].to_pylist()) ^ t["key"].to_numpy().view(np.uint64)[of]
    _, inverse, times = np.unique(both, return_inverse=True, return_counts=True)
    again = (times[inverse] > 1) & t["single"].to_numpy(zero_copy_only=False)[of]
    yield _runs(t["_d"], t["_th"], t["start"].to_numpy(), of, n, again)


def _hash_windows(parts: list[bytes]) -> np.ndarray:
    """Hashes of the windows of some regions, one after the other, a bounded number at a time."""
    out, i = [], 0
    while i < len(parts):
        j, size = i, 0
        while j < len(parts) and (j == i or size + len(parts[j]) <= PIECE):
            size += len(parts[j])
            j += 1
        ends = np.cumsum([len(p) for p in parts[i:j]])
        hashes = run_hashes(np.frombuffer(b"".join(parts[i:j]), np.uint8), MATCH)
        inside = np.ones(len(hashes), bool)
        for e in ends[:-1].tolist():
            inside[e - MATCH + 1:e] = False
        out.append(hashes[inside])
        i = j
    return np.concatenate(out)


def _runs(ids: pa.ChunkedArray, ths: pa.ChunkedArray, start: np.ndarray, of: np.ndarray, n: np.ndarray,
          again: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(again)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    row = of[at[first]]
    inner = at[first] - (np.cumsum(n) - n)[row]
    take = pa.array(row)
    return pa.RecordBatch.from_pydict({
        "_d": ids.take(take).combine_chunks(), "_th": ths.take(take).combine_chunks(),
        "start": pa.array((start[row] + inner).astype(np.int32)), "count": pa.array(count.astype(np.int32))})


def _wide_windows(regions: DataFrame) -> DataFrame:
    """The same for keys with very many regions: windows are counted by Spark."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                b = batch.slice(i, 256)
                parts = b.column("bytes").to_pylist()
                n = np.array([len(x) - MATCH + 1 for x in parts], dtype=np.int64)
                of = np.repeat(np.arange(len(n)), n)
                inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                rows = pa.array(of)
                yield pa.RecordBatch.from_pydict({
                    "_d": b.column("_d").take(rows), "_th": b.column("_th").take(rows), "key": b.column("key").take(rows),
                    "at": pa.array((b.column("start").to_numpy()[of] + inner).astype(np.int32)),
                    "single": b.column("single").take(rows), "h": pa.array(_hash_windows(parts).view(np.int64))})

    windows = stored(regions.mapInArrow(hashed, "_d long, _th string, key long, at int, single boolean, h long"))
    again = windows.groupBy("key", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key", "h")
    return windows.where("single").join(again, ["key", "h"]).select(
        "_d", "_th", F.col("at").alias("start"), F.lit(1).alias("count"))


def _regions(candidates: DataFrame) -> DataFrame:
    """The bytes of the regions that are to be compared window by window."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, (text, wanted) in enumerate(zip(batch.column("text").to_pylist(), batch.column("fetch").to_pylist())):
                raw = text.encode()
                out += [(row, s["key"], s["start"], s["single"], s["k"], raw[s["start"]:s["start"] + s["count"] + MATCH - 1])
                        for s in wanted]
            rows = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "_d": batch.column("_d").take(rows), "_th": batch.column("_th").take(rows),
                **{c: pa.array([x[i] for x in out], kind) for i, (c, kind) in enumerate((
                    ("key", pa.int64()), ("start", pa.int32()), ("single", pa.bool_()), ("k", pa.int64()), ("bytes", pa.binary())), 1)}})

    return candidates.where(F.size("fetch") > 0).select("_d", "_th", "text", "fetch").mapInArrow(
        work, "_d long, _th string, key long, start int, single boolean, k long, bytes binary")


def _cut(found: DataFrame) -> DataFrame:
    """`_d, _th, n_removed, n_spans, kept` of texts with the windows that repeat."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_removed, n_spans, kept = [], [], []
            for text, whole, more in zip(batch.column("text").to_pylist(), batch.column("whole").to_pylist(), batch.column("runs").to_pylist()):
                raw, out, at, removed, runs, end = text.encode(), [], 0, 0, 0, -1
                for s in sorted((whole or []) + (more or []), key=lambda s: s["start"]):
                    first, last = s["start"], s["start"] + s["count"] + MATCH - 1
                    if first > end:  # touching runs are one
                        runs += 1
                    out.append(raw[at:max(at, first)])
                    removed += max(0, last - max(at, first))
                    at, end = max(at, last), max(end, last)
                n_removed.append(removed)
                n_spans.append(runs)
                kept.append(b"".join(out) + raw[at:])
            yield pa.RecordBatch.from_pydict({
                "_d": batch.column("_d"), "_th": batch.column("_th"), "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return found.mapInArrow(work, "_d long, _th string, n_removed long, n_spans long, kept binary")


def _listed(spans: DataFrame, by: list[str], name: str) -> DataFrame:
    """The spans of a text in one list; a text has at most one for each of its bytes."""
    return spans.groupBy(*by).agg(F.collect_list(F.struct(*[c for c in spans.columns if c not in by])).alias(name))


def remove_repeats(docs: DataFrame, batches: int = BATCHES, wide: int = WIDE) -> tuple[DataFrame, DataFrame]:
    """Two tables: all documents, `doc_id, _th, n_bytes, sha` (of the whole text) and `copies`
    (documents with the same text); and the texts that lose some bytes by repeats in other texts
    or in themselves: `_th, n_removed, n_spans, kept` (the bytes that stay).

    A byte goes if a MATCH-byte string that covers it also starts anywhere else in
    `docs(doc_id, text)`. Texts of MATCH bytes or more that several documents have, rows equal in
    doc_id included, go as a whole and are not in the second table. Null texts count as empty;
    shorter texts lose nothing; null doc_ids are documents like others. An empty table gives two
    empty ones. Other columns are not read. Strings are compared by two 64-bit hashes, texts by
    a 128-bit one.
    """
    spark = docs.sparkSession
    rows = stored(suffixes(docs))
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (512 << 20)))
    family = Family(spark, buckets)
    try:
        for b in range(batches):
            family.add(_combined(rows.where(F.pmod(F.xxhash64("_th"), F.lit(batches)) == b)))
        family.drop_levels()
        repeated = stored(family.repeated())
    finally:
        family.drop()
    texts = rows.groupBy("_th").agg(F.count(F.lit(1)).alias("copies"), F.min("_d").alias("_first"))
    known = stored(rows.select("_n", "_d", "_th").join(texts, "_th"))
    marked = stored(_exploded(rows).join(repeated, ["key", "region"]).select(
        "_n", "start", "count", (F.col("n") == 1).alias("single"), "k", "open",
        *[F.when(F.col("open"), F.col(c)).alias(c) for c in ("key", "region")]))
    # One region stands for its equals when windows are compared.
    fetch = (marked.where("open").groupBy("key", "region").agg(F.min(F.struct("_n", "start", "count", "single", "k")).alias("r"))
             .select("r._n", "key", "r.start", "r.count", "r.single", "r.k"))
    fetch = _listed(fetch.join(known, "_n").select("_th", "key", "start", "count", "single", "k"), ["_th"], "fetch")
    whole = _listed(marked.where(~F.col("single")).select("_n", "start", "count"), ["_n"], "whole")
    whole = whole.join(known.where(F.col("copies") == 1), "_n").select("_th", "whole")
    wanted = fetch.join(whole, "_th", "full").join(texts, "_th").select(
        "_th", F.col("_first").alias("_d"), F.coalesce("fetch", F.array().cast(fetch.schema["fetch"].dataType)).alias("fetch"), "whole")
    # Kept in buckets of the join's own keys: the texts are shuffled once.
    found = _texts(docs).join(wanted, ["_th", "_d"]).dropDuplicates(["_th", "_d"])
    name = f"candidates_{uuid.uuid4().hex}"
    try:
        found.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "_th", "_d").saveAsTable(name)
        candidates = spark.table(name)
        regions = stored(_regions(candidates))
        narrow = regions.where(F.col("k") <= wide).drop("k").repartition("key").sortWithinPartitions("key")
        runs = _windows(narrow)
        if not regions.where(F.col("k") > wide).isEmpty():
            runs = runs.union(_wide_windows(regions.where(F.col("k") > wide).drop("k")))
        lists = _listed(runs, ["_th", "_d"], "runs")
        both = candidates.select("_th", "_d", "text", "whole").join(lists, ["_th", "_d"], "left")
        lost = stored(_cut(both.where(F.col("whole").isNotNull() | F.col("runs").isNotNull())).drop("_d"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    doc_id = F.when(~F.col("_null"), F.col("_d")).alias("doc_id")
    return rows.select("_d", "_null", "_th", "n_bytes", "sha").join(texts, "_th").select(doc_id, "_th", "n_bytes", "sha", "copies"), lost


def digests(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256` of all documents."""
    short = lost.select("_th", F.col("n_removed").alias("_r"), F.col("n_spans").alias("_s"), F.sha2("kept", 256).alias("_k"))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= MATCH)
    zero = F.lit(0).cast("long")
    return rows.join(short, "_th", "left").select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("_r", zero)).alias("n_removed"),
        F.when(gone, zero + 1).otherwise(F.coalesce("_s", zero)).alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("_k", "sha")).alias("kept_sha256"))
