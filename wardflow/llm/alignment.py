"""Two tokenizers of one corpus held against each other.

Exact-text deduplication: documents are shuffled by their full text, each distinct text is tokenised
by both tokenizers and aligned once, pair counts are weighted with how often the text occurs, and
the measures are joined back to the documents by the SHA-256 of the text.

Both token sequences of a text cover the same bytes. Byte offsets where a token of either ends cut
the text into segments, each inside one A and one B token: the links. Offsets where both end close
a group.

A space after a character that is no white space is a border for both tokenizers (for B as long as
no piece has a space after another character, which is looked up), so a text is the sequence of its
parts between such places, and a worker aligns each part once for as long as it remembers it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, once, ragged, stored

CACHE = 350_000          # parts whose alignment a worker remembers
CHUNK = 2_000_000        # characters whose links are sorted at once; longer texts take several chunks
LEARN = 2000             # new parts that are tokenised in one call
SLICE = 1 << 20          # pairs of one broadcast slice of the pair counts
HELD = 2_000_000         # pair counts a task combines before it hands them on

_NO_BORDER = re.compile(r"\A | \Z|\s ")
_BORDER = re.compile(r"(?<=\S) (?=.)", re.DOTALL)

_CHUNK_SCHEMA = ("keys array<binary>, copies array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                 "n_links array<long>, digests array<string>, n_pairs long, pairs binary, pair_texts binary, "
                 "texts binary, times binary")


def _byte_of_character() -> dict[str, int]:
    """What byte each character of a byte-level entry stands for: printable ones for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


class Aligner:
    """Parts of texts and their alignment, remembered by number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one worker for each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _byte_of_character()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes_a[i] = bytes(byte[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.borders = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lengths_a = np.array([len(x) for x in self.bytes_a])
        self.lengths_b = np.array([len(x) for x in self.bytes_b])
        self.n_b_ids = len(self.bytes_b)
        n_ids = max(len(self.bytes_a), len(self.bytes_b))
        # An id as text, with the mark that follows it inside a group, after the A ids, after the group.
        self.written = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(n_ids)], pa.string())
        self.n_ids = n_ids
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes | None] = []
        self.numbers: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.used: np.ndarray = np.zeros(0, dtype=np.int64)

    def trim(self) -> None:
        """Forget the half of the parts that was met least, if there are too many."""
        if len(self.known) <= CACHE:
            return
        table, links, starts = self.tables()
        used = np.zeros(len(self.groups), dtype=np.int64)
        used[:len(self.used)] = self.used
        kept = np.sort(np.argsort(used, kind="stable")[-(CACHE // 2):])
        names = list(self.known)  # numbers are given in order of arrival
        groups = self.groups
        self.known = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.groups = [groups[i] for i in kept.tolist()]
        self.numbers = [table[kept]]
        self.links = [links[ragged(starts[kept], table[kept, 3])]]
        self.used = used[kept] // 2

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per part n_a, n_b, n_groups, n_links; the pairs of all parts; where those of a part start."""
        if len(self.numbers) != 1:
            self.numbers = [np.concatenate([np.zeros((0, 4), dtype=np.int64), *self.numbers])]
            self.links = [np.concatenate([np.zeros(0, dtype=np.int64), *self.links])]
        sizes = self.numbers[0][:, 3]
        return self.numbers[0], self.links[0], np.cumsum(sizes) - sizes

    def parts(self, text: str) -> list[str]:
        if not self.borders:
            return [text]
        return _BORDER.split(text) if _NO_BORDER.search(text) else text.split(" ")

    def learn(self, parts: list[str]) -> None:
        # A part that ends with white space is the last of its text and is tokenised by itself.
        alone = [p for p in parts if not p or p[-1].isspace()] if self.borders else parts
        joined = [p for p in parts if p and not p[-1].isspace()] if self.borders else []
        for i in range(0, len(joined), LEARN):
            self._learn(joined[i:i + LEARN])
        for p in alone:
            self._learn([p])

    def _learn(self, parts: list[str]) -> None:
        text = " ".join(parts)
        ids_a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, dtype=np.int64)
        ids_b = np.array(self.b.encode(text, num_threads=1), dtype=np.int64)
        want = b" " + text.encode()
        if (b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != want
                or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != want):
            if len(parts) > 1:
                half = len(parts) // 2
                self._learn(parts[:half])
                self._learn(parts[half:])
            else:
                self.known[parts[0]] = len(self.groups)
                self.groups.append(None)
                self.numbers.append(np.zeros((1, 4), dtype=np.int64))
            return
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        at = np.zeros(len(want) + 1, dtype=np.int8)
        at[ends_a] += 1
        at[ends_b] += 1
        cuts, both = np.flatnonzero(at), np.flatnonzero(at == 2)
        pairs = ids_a[np.searchsorted(ends_a, cuts)] * self.n_b_ids + ids_b[np.searchsorted(ends_b, cuts)]
        # Ids in the order of the written form: by group, A before B.
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        written = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        written[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)] = ids_a + self.n_ids * (at[ends_a] == 2)
        written[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")] = ids_b + 2 * self.n_ids * (at[ends_b] == 2)
        marks = self.written.take(pa.array(written))
        offsets = np.frombuffer(marks.buffers()[1], np.int32)[:len(marks) + 1]
        data = marks.buffers()[2].to_pybytes()
        # A common end closes each part.
        part_ends = np.cumsum([1 + len(p.encode()) for p in parts])
        n = [np.searchsorted(x, part_ends, "right") for x in (ends_a, ends_b, both, cuts)]
        first = offsets[np.concatenate([[0], n[0] + n[1]])].tolist()
        number = len(self.groups)
        for p, i, j in zip(parts, first, first[1:]):
            self.known[p] = number
            self.groups.append(data[i:j - 1])
            number += 1
        self.numbers.append(np.diff(np.stack([np.concatenate([[0], x]) for x in n], axis=1), axis=0))
        self.links.append(pairs)

    def numbered(self, texts: list[str]) -> list[np.ndarray]:
        """Each text as the numbers of its parts."""
        parts = [self.parts(t) for t in texts]
        new = set().union(*parts).difference(self.known)
        if new:
            self.learn(list(new))
        known = self.known.__getitem__
        return [np.fromiter(map(known, p), np.int64, len(p)) for p in parts]


def _chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most `most` together, or of one alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def _linked(aligner: Aligner, rows: list[tuple[bytes, int, np.ndarray, str]]) -> pa.RecordBatch:
    """One row for some texts, or for some of the parts of one text: measures and links."""
    table, links, starts = aligner.tables()
    owner = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    parts = np.concatenate([np.zeros(0, dtype=np.int64), *[r[2] for r in rows]])
    sums = np.stack([np.bincount(owner, table[parts, c], len(rows)) for c in range(4)]).astype(np.int64)
    sizes = table[parts, 3]
    codes = links[ragged(starts[parts], sizes)] * len(rows) + np.repeat(owner, sizes)
    codes.sort()
    new = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.append(new, len(codes)))
    pairs, texts = np.divmod(codes[new], len(rows))
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, dtype=np.int64)
    values = {
        "keys": [[r[0] for r in rows]], "copies": [[r[1] for r in rows]], "n_a": [sums[0]], "n_b": [sums[1]],
        "n_groups": [sums[2]], "n_links": [sums[3]], "digests": [[r[3] for r in rows]], "n_pairs": [len(first)],
        "pairs": [_packed(np.diff(pairs[first], prepend=0).astype("<i8"))],
        "pair_texts": [_packed(np.diff(np.append(first, len(pairs))).astype("<i4"))],
        "texts": [_packed(texts.astype("<i4"))], "times": [_packed(times.astype("<i4"))]}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, _TYPES[c]) for c, v in values.items()], names=list(values))


_TYPES = {"keys": pa.list_(pa.binary()), "digests": pa.list_(pa.string()), "n_pairs": pa.int64(),
          **{c: pa.list_(pa.int64()) for c in ("copies", "n_a", "n_b", "n_groups", "n_links")},
          **{c: pa.binary() for c in ("pairs", "pair_texts", "texts", "times")}}


def align_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of _CHUNK_SCHEMA of the distinct, non-empty `texts(text, key, copies)`; texts whose bytes
    one of the tokenizers does not give back are left out. A long text has several entries, which
    add up; its digest stands in the last one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = once(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys, copies = batch.column("key").to_pylist(), batch.column("copies").to_pylist()
            for i, j in _chunks([len(t) for t in texts], CHUNK):
                aligner.trim()
                rows = []
                for k, parts in enumerate(aligner.numbered(texts[i:j]), i):
                    groups = list(map(aligner.groups.__getitem__, parts.tolist()))
                    if None not in groups:
                        rows.append((keys[k], copies[k], parts, hashlib.sha256(b";".join(groups)).hexdigest()))
                every = np.concatenate([np.zeros(0, dtype=np.int64), *[r[2] for r in rows]])
                used = np.bincount(every, minlength=len(aligner.groups))
                used[:len(aligner.used)] += aligner.used
                aligner.used = used
                if len(rows) == 1 and len(texts[i]) > CHUNK:
                    key, n, parts, digest = rows[0]
                    cuts = [parts[a:b] for a, b in _chunks(aligner.tables()[0][parts, 3].tolist(), CHUNK)]
                    for c in cuts[:-1]:
                        yield _linked(aligner, [(key, n, c, "")])
                    rows = [(key, n, cuts[-1], digest)]
                if rows:
                    yield _linked(aligner, rows)

    bounded_batches(texts.sparkSession)
    return texts.select("text", "key", "copies").mapInArrow(work, _CHUNK_SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """`pair, n`: links of each id pair over the corpus, copies of a text included."""
    def combined(held: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(held, axis=1)
        pairs, where = np.unique(both[0], return_inverse=True)
        n = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(n, where, both[1])
        return np.stack([pairs, n])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for r in batch.to_pylist():
                pairs, counts, texts = _unpacked(r["pairs"], "<i8"), _unpacked(r["pair_texts"], "<i4"), _unpacked(r["texts"], "<i4")
                if len(pairs):
                    weighted = _unpacked(r["times"], "<i4").astype(np.int64) * np.array(r["copies"], dtype=np.int64)[texts]
                    ends = np.cumsum(counts, dtype=np.int64)
                    held.append(np.stack([np.cumsum(pairs), np.add.reduceat(weighted, ends - counts)]))
                if sum(h.shape[1] for h in held) > HELD:
                    held = [combined(held)]
                    if held[0].shape[1] > HELD // 2:
                        yield _pairs(held.pop())
        if held:
            yield _pairs(combined(held))

    def _pairs(both: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"pair": pa.array(both[0]), "n": pa.array(both[1])})

    return (aligned.select("pairs", "pair_texts", "texts", "times", "copies").mapInArrow(work, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def _measured(aligned: DataFrame, counts: DataFrame, n_b_ids: int) -> DataFrame:
    """`key`, the measures of its entry, and what its links add to `n_best` and `count_sum`.

    The pair counts are walked in slices by B id, so that all pairs of a B id are in one slice; a
    slice of about SLICE pairs is broadcast, each for one pass over the links.
    """
    spark = aligned.sparkSession
    n_slices = max(1, -(-counts.count() // SLICE))

    def one(k: int) -> DataFrame:
        part = counts.where(F.col("pair") % n_b_ids % n_slices == k).toArrow()
        pairs, n = part["pair"].to_numpy(), part["n"].to_numpy()
        order = np.lexsort((pairs, pairs % n_b_ids))
        ids = pairs[order] % n_b_ids
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else []
        top = np.zeros(len(pairs), dtype=np.int64)
        if len(ids):
            top[order] = np.repeat(np.maximum.reduceat(n[order], starts), np.diff(np.append(starts, len(ids))))
        by_pair = np.argsort(pairs)
        shared = spark.sparkContext.broadcast((pairs[by_pair], n[by_pair], (n == top)[by_pair]))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, n, best = shared.value
            for batch in batches:
                for r in batch.to_pylist():
                    size = len(r["keys"])
                    sums, bests = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
                    pairs = np.cumsum(_unpacked(r["pairs"], "<i8"))
                    here = pairs % n_b_ids % n_slices == k
                    at = np.searchsorted(known, pairs[here])
                    value, top = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
                    value[here], top[here] = n[at], best[at]
                    sizes = _unpacked(r["pair_texts"], "<i4")
                    texts, times = _unpacked(r["texts"], "<i4"), _unpacked(r["times"], "<i4").astype(np.int64)
                    np.add.at(sums, texts, times * np.repeat(value, sizes))
                    np.add.at(bests, texts, times * np.repeat(top, sizes))
                    first = k == 0
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(r["keys"], pa.binary()),
                        **{c: pa.array(r[c] if first else [0] * size, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
                        "n_best": pa.array(bests), "count_sum": pa.array(sums),
                        "groups_sha256": pa.array(r["digests"] if first else [""] * size, pa.string())})

        return aligned.mapInArrow(
            work, "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

    return reduce(DataFrame.unionAll, [one(k) for k in range(n_slices)])


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """The alignment of each row of `docs(doc_id, text)`, and the id pairs `a, b, n` of the corpus.

    A, a byte-level vocabulary of the tokenizers library, reads the text with a space before it; B,
    a sentencepiece model, adds that space itself. Strings of special tokens are plain text. Rows
    whose text is null, empty or not given back byte for byte by both have zeros, and '' as
    `groups_sha256`. One row per input row: equal rows give equal rows, a null doc_id stays null, an
    empty table gives none. Other columns are not read. A text of any length is aligned whole, a
    few million links at a time; only a text without white space is tokenised in one piece.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    filled = F.length("text") > 0
    key = F.unhex(F.sha2("text", 256)).alias("key")
    distinct = chosen.where(filled).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = stored(align_texts(distinct.select("text", key, "copies"), path_a, path_b))
    counts = stored(pair_counts(aligned))
    import sentencepiece

    n_b_ids = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    per_text = stored(_measured(aligned, counts, n_b_ids).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in MEASURES], F.max("groups_sha256").alias("groups_sha256")))
    found = chosen.where(filled).select("doc_id", key).join(per_text, "key", "left").drop("key")
    others = chosen.where(~F.coalesce(filled, F.lit(False))).select(
        "doc_id", *[F.lit(None).cast("long").alias(c) for c in MEASURES], F.lit(None).cast("string").alias("groups_sha256"))
    rows = found.unionByName(others).select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return rows, counts.select(
        F.expr(f"pair div {n_b_ids}").alias("a"), (F.col("pair") % n_b_ids).alias("b"), "n")
