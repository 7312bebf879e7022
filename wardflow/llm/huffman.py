"""Token ids of a corpus in Huffman-coded files.

Texts are tokenised once and ids kept; their counts over the whole corpus give one canonical code
whose lengths are limited (package-merge), so that decoding takes one table look-up per id. Each
document starts on a byte and is cut into blocks of BLOCK ids whose bit offsets are kept, so every
block can be decoded by itself, many at once.

File format, two Parquet folders under one path:

- `codebook`: `id, length`, the code lengths; codes are assigned by length, then id.
- `segments`: documents in ascending doc_id (null first), one row per segment of some documents:
  `segment, start` (ids before it), `doc_ids, doc_tokens, doc_bytes` (per document), `block_bits`
  (bit offset of each block within its document), `payload`.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from itertools import filterfalse, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, once, stored

BLOCK = 256                # ids of a block
LIMIT = 18                 # bits of the longest code
SEGMENT_BYTES = 4 << 20    # payload of a segment, more only if one document has more
RANGE_IDS = 1 << 23        # ids of one range of documents, sorted in one task
CACHE = 900_000            # words whose ids a worker remembers
PART = 6 << 20             # characters of texts that are cut into words at once

_PUNCTUATION = string.punctuation.replace("'", "")

_SEGMENT = ("segment long, start long, doc_ids array<long>, doc_tokens array<int>, doc_bytes array<int>, "
            "block_bits array<int>, payload binary")


class Words:
    """Ids of texts by way of their words, each of which the tokenizers library encodes once.

    A place between a character that is no white space and a space is a border of the byte-level
    splitting wherever it stands, so the ids of the parts between such places, each with its
    leading space, are the ids of the text. Texts that hold an added token of the library, which
    it looks for before it splits, are encoded by it as a whole.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one worker for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = dtype
        vocab = self.library.get_vocab(with_added_tokens=False)
        # Each character of a byte-level token stands for one byte.
        self.lengths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        self.lengths[list(vocab.values())] = [len(t) for t in vocab]
        self.known: dict[str, bytes | None] = {}  # with a space before
        self.starts: dict[str, bytes] = {}  # first words of texts
        self.bare: dict[str, bytes] = {"\n": self._ids("\n").astype(dtype).tobytes(), "": b""}  # without

    def _ids(self, text: str) -> np.ndarray:
        # The fast form makes no character offsets.
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        """Ids of ` word` for new words; None for those after which a space is no border.

        Between a letter or digit and punctuation other than an apostrophe the splitting has a
        border too, and on both sides of a single new line between other characters. So words that
        differ in such ends alone share what is encoded.
        """
        sure, bare = set(), set()
        # Lists side by side: a tuple for each word would keep the garbage collector busy.
        ended, ended_cores, ends = [], [], []
        lined, lined_cores, before, after, behind = [], [], [], [], []
        sure.update(filter(str.isalnum, new))
        for w in filterfalse(str.isalnum, new):
            if not w or w[-1].isspace():
                self.known[w] = None
                continue
            head, line, rest = w.partition("\n")
            core = head.rstrip(_PUNCTUATION)
            if not core or not core[-1].isascii() or not core[-1].isalnum():
                sure.add(w)
            elif line:
                begin = rest.rstrip(_PUNCTUATION)
                if begin.isascii() and begin.isalnum():
                    lined.append(w)
                    lined_cores.append(core)
                    before.append(head[len(core):])
                    after.append(begin)
                    behind.append(rest[len(begin):])
                else:
                    sure.add(w)
            elif len(core) < len(head):
                ended.append(w)
                ended_cores.append(core)
                ends.append(head[len(core):])
            else:
                sure.add(w)
        for cores in (ended_cores, lined_cores):
            sure.update(cores)
        for parts in (ends, before, after, behind):
            bare.update(parts)
        self._learn_bare(list(bare.difference(self.bare)))
        self._learn_words(list(sure.difference(self.known)))
        known, part, line = self.known, self.bare, self.bare["\n"]
        for w, core, end in zip(ended, ended_cores, ends):
            known[w] = known[core] + part[end]
        for w, core, x, y, z in zip(lined, lined_cores, before, after, behind):
            known[w] = known[core] + part[x] + line + part[y] + part[z]

    def _learn_bare(self, new: list[str]) -> None:
        """Letters and digits, or punctuation, without a space before: one to a line."""
        size = np.dtype(self.dtype).itemsize
        for i in range(0, len(new), 2000):
            some = new[i:i + 2000]
            ids = self._ids("\n".join(some))
            at = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w) + 1 for w in some]) - 1) + 1
            data = ids.astype(self.dtype).tobytes()
            begin = 0
            for w, end in zip(some, at.tolist()):
                self.bare[w] = data[begin * size:end * size]
                begin = end + 1  # the new line

    def _learn_words(self, sure: list[str]) -> None:
        for i in range(0, len(sure), 2000):
            some = sure[i:i + 2000]
            ids = self._ids(" " + " ".join(some))
            ends = np.cumsum([1 + len(w.encode()) for w in some])
            at = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            data, size = ids.astype(self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            begin = 0
            for w, end in zip(some, at.tolist()):
                self.known[w] = data[begin * size:end * size]
                begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i: self._ids(t).astype(self.dtype).tobytes() for i, t in enumerate(texts) if any(a in t for a in self.added)}
        if not whole:
            return self._by_words(texts)
        others = iter(self._by_words([t for i, t in enumerate(texts) if i not in whole]))
        return [whole[i] if i in whole else next(others) for i in range(len(texts))]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        first = 0
        while first < len(texts):
            last, n_chars = first, 0
            while last < len(texts) and (last == first or n_chars + len(texts[last]) <= PART):
                n_chars += len(texts[last])
                last += 1
            # Words meet in a table of their own, so that each distinct one is looked up once.
            lists = pc.split_pattern(pa.array(texts[first:last], pa.large_string()), " ")
            words = lists.flatten().dictionary_encode()
            names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
            which, bounds = words.indices.to_numpy(), lists.offsets.to_numpy()
            found = list(map(self.known.get, names))
            new = [w for w, x in zip(names, found) if x is None and w not in self.known]
            if len(self.known) + len(self.bare) + len(new) > CACHE:
                # Frequent words are met first: the older half stays.
                self.known = dict(islice(self.known.items(), CACHE // 2))
                self.bare = dict(islice(self.bare.items(), CACHE // 8))
                new = [w for w in names if w not in self.known]
                found = [None] * len(names)
            if new:
                self._learn(new)
                found = [self.known[w] if x is None else x for w, x in zip(names, found)]
            # The first word of a text has no space before it.
            which = which.astype(np.int64)
            which[bounds[:-1]] = len(found)
            joined = pa.array([*found, b""], pa.large_binary()).take(pa.array(which))
            unsure = np.logical_or.reduceat(joined.is_null().to_numpy(zero_copy_only=False), bounds[:-1])
            _, places, data = joined.buffers()
            ends = np.frombuffer(places, np.int64)[bounds].tolist()
            data = memoryview(b"" if data is None else data)
            starts = words.indices.to_numpy()[bounds[:-1]].tolist()
            for i, at in enumerate(starts):
                start = names[at]
                # An unsure part, the first one included, takes its text by longer parts.
                if unsure[i] or not start or start[-1].isspace():
                    out.append(self._by_longer_parts(texts[first + i].split(" ")))
                else:
                    out.append(self._start(start) + data[ends[i]:ends[i + 1]])
            first = last
        return out

    def _start(self, word: str) -> bytes:
        if (found := self.starts.get(word)) is None:
            if len(self.starts) > CACHE // 8:
                self.starts.clear()
            found = self.starts[word] = self._ids(word).astype(self.dtype).tobytes()
        return found

    def _by_longer_parts(self, parts: list[str]) -> bytes:
        whole, now = [], parts[0]
        for p in parts[1:]:
            if now and not now[-1].isspace():
                whole.append(now)
                now = " " + p
            else:
                now += " " + p
        return b"".join(self._ids(w).astype(self.dtype).tobytes() if (k := self._remembered(w)) is None else k
                        for w in [*whole, now])

    def _remembered(self, part: str) -> bytes | None:
        return self.known.get(part[1:]) if part[:1] == " " else None



def tokenise(docs: DataFrame, path: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """`doc_id, row, n_tokens, ids` of whole texts, `end_id` at the end of each; ids as `dtype`. `row`
    tells equal rows apart."""
    end = np.array([end_id], dtype=dtype).tobytes()
    size = np.dtype(dtype).itemsize

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = once(("words", path, dtype), lambda: Words(path, dtype))
        for batch in batches:
            ids = [x + end for x in words.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_tokens": pa.array([len(x) // size for x in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary())})

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(
        work, "doc_id long, row long, n_tokens long, ids binary")


# The code.

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code, 0 for those that do not occur: the best prefix code without
    a code of over `limit` bits, by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n == 1:
        lengths[used] = 1
    if n < 2:
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of over {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = level[:len(level) // 2 * 2]
        packages = even[::2] + even[1::2]
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        level = both[by]
        is_leaf.append(by < n)
    need = 2 * n - 2
    for flags in reversed(is_leaf):
        taken = int(flags[:need].sum())
        lengths[order[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length and then symbol, first bit highest."""
    codes = np.zeros(len(lengths), dtype=np.int64)
    code, before = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for s in order[lengths[order] > 0].tolist():
        code <<= int(lengths[s]) - before
        before = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for each possible next `limit` bits."""
    codes = canonical(lengths)
    symbol, length = np.zeros(1 << limit, dtype=np.uint32), np.zeros(1 << limit, dtype=np.uint8)
    for s in np.flatnonzero(lengths).tolist():
        room = limit - int(lengths[s])
        begin = int(codes[s]) << room
        symbol[begin:begin + (1 << room)] = s
        length[begin:begin + (1 << room)] = lengths[s]
    return symbol, length


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of one document and the bit offset of each of its blocks. Codes have 25 bits at most."""
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    total = int(end[-1]) if len(ids) else 0
    size = (total + 7) // 8
    word = codes[ids] << (32 - n - (at & 7))
    out = np.zeros(size + 4, dtype=np.float64)
    for k in range(4):
        out += np.bincount((at >> 3) + k, weights=(word >> (24 - 8 * k)) & 255, minlength=size + 4)
    return out[:size].astype(np.uint8).tobytes(), at[::BLOCK]


def unpack(payload: np.ndarray, first_bits: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray],
           limit: int = LIMIT) -> np.ndarray:
    """Ids of many blocks, one after the other: each step takes the next id of every block."""
    symbol, length = table
    data = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
    out = np.zeros(int(sizes.sum()), dtype=np.uint32)
    place = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    bits, place, left = first_bits[order].astype(np.int64), place[order], sizes[order]
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step))  # blocks with more than `step` ids come first
        bits, place = bits[:live], place[:live]
        b = bits >> 3
        word = data[b] << 24 | data[b + 1] << 16 | data[b + 2] << 8 | data[b + 3]
        key = (word >> (32 - limit - (bits & 7)).astype(np.uint32)) & np.uint32((1 << limit) - 1)
        out[place + step] = symbol[key]
        bits = bits + length[key]
    return out


# Jobs.

class Ranges(NamedTuple):
    """Places of documents in ascending order: those of null doc_ids, then ranges of doc_id.

    A doc_id with so many rows that it bounds several ranges, or null, is dealt to all of them by row number: its
    rows may stand in any order.
    """

    bounds: np.ndarray
    n_null: int

    @property
    def count(self) -> int:
        return len(self.bounds) + self.n_null

    def place(self, ids: pa.Array, rows: pa.Array) -> np.ndarray:
        values, row = ids.fill_null(0).to_numpy(zero_copy_only=False), rows.to_numpy(zero_copy_only=False)
        left, right = (np.searchsorted(self.bounds, values, side=s) for s in ("left", "right"))
        # The last place of null ids is shared with the first range.
        place = np.where(right - left > 1, left + 1 + row % np.maximum(right - left, 1), right) + self.n_null - 1
        null = ids.is_null().to_numpy(zero_copy_only=False)
        place[null] = row[null] % self.n_null
        return place


def _ranges(tokens: DataFrame) -> Ranges:
    """Ranges of doc_id with about RANGE_IDS ids each."""
    n_ids, n_null = tokens.agg(F.sum("n_tokens"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n_tokens")))).first()
    n = max(1, -(-(n_ids or 0) // RANGE_IDS))
    found = tokens.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    return Ranges(np.sort(np.array(found, dtype=np.float64).astype(np.int64)), max(1, -(-(n_null or 0) // RANGE_IDS)))


def _counts(tokens: DataFrame, dtype: str, dealt: Ranges) -> DataFrame:
    """`of, key, n`: how often each id occurs ('id') and the ids of each range ('range')."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ranges = np.zeros(1, np.int64), np.zeros(dealt.count, np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                more = np.bincount(np.frombuffer(raw, dtype), minlength=len(ids))
                more[:len(ids)] += ids
                ids = more
            ranges += np.bincount(dealt.place(batch.column("doc_id"), batch.column("row")), minlength=len(ranges),
                                  weights=batch.column("n_tokens").to_numpy()).astype(np.int64)
        for of, n in (("id", ids), ("range", ranges)):
            key = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"of": pa.array([of] * len(key), pa.string()),
                                              "key": pa.array(key, pa.int64()), "n": pa.array(n[key], pa.int64())})

    return tokens.select("doc_id", "row", "n_tokens", "ids").mapInArrow(work, "of string, key long, n long").groupBy(
        "of", "key").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, dtype: str = "<u2") -> None:
    """Writes the ids of `docs(doc_id, text)` to `path` in the format above.

    Null texts count as empty and have the end id alone; rows with null doc_id come first; rows
    with equal doc_id follow each other in any order; an empty table gives an empty codebook and
    no segment. Other columns are not read. What the driver gets is the counts: one number for
    each id of the vocabulary and each range.
    """
    spark = docs.sparkSession
    tokens = stored(tokenise(docs, tokenizer, end_id, dtype))
    dealt = _ranges(tokens)
    counts = {"id": {}, "range": {}}
    for r in _counts(tokens, dtype, dealt).collect():
        counts[r.of][r.key] = r.n
    freq = np.zeros(max(counts["id"], default=0) + 1, dtype=np.int64)
    for k, n in counts["id"].items():
        freq[k] = n
    lengths = code_lengths(freq)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used], pa.int32())})
    ).coalesce(1).write.parquet(f"{path}/codebook")
    codes = canonical(lengths)
    sums = np.array([counts["range"].get(i, 0) for i in range(dealt.count)], dtype=np.int64)
    starts = np.cumsum(sums) - sums

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [pack(np.frombuffer(x, dtype), codes, lengths) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(dealt.place(batch.column("doc_id"), batch.column("row")), pa.int32()),
                "doc_id": batch.column("doc_id"), "n_tokens": batch.column("n_tokens"),
                "payload": pa.array([p for p, _ in both], pa.binary()),
                "bits": pa.array([b.astype(np.int32) for _, b in both], pa.list_(pa.int32()))})

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, held, size, number, place = None, [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            n = [r["n_tokens"] for r in held]
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([place << 32 | number], pa.int64()), "start": pa.array([start], pa.int64()),
                "doc_ids": pa.array([[r["doc_id"] for r in held]], pa.list_(pa.int64())),
                "doc_tokens": pa.array([n], pa.list_(pa.int32())),
                "doc_bytes": pa.array([[len(r["payload"]) for r in held]], pa.list_(pa.int32())),
                "block_bits": pa.array([[b for r in held for b in r["bits"]]], pa.list_(pa.int32())),
                "payload": pa.array([b"".join(r["payload"] for r in held)], pa.binary())})

        for batch in batches:
            for r in batch.to_pylist():
                if start is None:
                    place = r["place"]
                    start = int(starts[place])
                if held and size + len(r["payload"]) > SEGMENT_BYTES:
                    yield segment()
                    start += sum(x["n_tokens"] for x in held)
                    held, size, number = [], 0, number + 1
                held.append(r)
                size += len(r["payload"])
        if held:
            yield segment()

    coded = tokens.mapInArrow(packed, "place int, doc_id long, n_tokens long, payload binary, bits array<int>")
    (coded.repartitionById(dealt.count, "place").sortWithinPartitions("place", F.asc_nulls_first("doc_id"))
     .mapInArrow(segments, _SEGMENT).write.parquet(f"{path}/segments"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` from the files: ids as little-endian unsigned 32-bit
    integers, `start` the number of ids of all documents before."""
    book = spark.read.schema("id long, length int").parquet(f"{path}/codebook").toArrow()  # the vocabulary at most
    lengths = np.zeros(max(book["id"].to_pylist(), default=0) + 1, dtype=np.uint8)
    lengths[book["id"].to_numpy()] = book["length"].to_numpy()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for r in batch.to_pylist():
                n = np.array(r["doc_tokens"], dtype=np.int64)
                n_bytes = np.array(r["doc_bytes"], dtype=np.int64)
                blocks = -(-n // BLOCK)
                of = np.repeat(np.arange(len(n)), blocks)
                sizes = np.full(len(of), BLOCK, dtype=np.int64)
                last = np.cumsum(blocks)[blocks > 0] - 1
                sizes[last] = (n - (blocks - 1) * BLOCK)[blocks > 0]
                first = (np.cumsum(n_bytes) - n_bytes)[of] * 8 + np.array(r["block_bits"], dtype=np.int64)
                ids = unpack(np.frombuffer(r["payload"], np.uint8), first, sizes, table).astype("<u4")
                end = np.cumsum(n)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "start": pa.array(r["start"] + end - n, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                    "ids": pa.array([ids[e - k:e].tobytes() for e, k in zip(end.tolist(), n.tolist())], pa.binary())})

    bounded_batches(spark)
    return spark.read.schema(_SEGMENT).parquet(f"{path}/segments").mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids binary")
