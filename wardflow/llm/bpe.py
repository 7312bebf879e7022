"""Byte-level BPE as a tree reduction over a text.

A text is cut in halves down to leaves, leaves are encoded, and neighbours are joined by
encoding a window around their border again. The window grows until what lies outside provably
keeps its tokens:

- In text, a border between a character that is no white space and a following space is a match
  border of the pattern wherever the scan began, so tokens beyond two such places stay.
- Inside one long match, a token sequence is the encoding of its bytes if and only if each pair of
  neighbouring tokens is the encoding of its own bytes, so tokens stay once the pairs at both ends
  of the window pass that test.

Joining is associative, so any tree over the leaves gives the same ids. Decoding concatenates the
bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, once

LEAF = 1024      # characters that are encoded at once
WINDOW = 4096    # a border window up to this size is encoded at once; beyond, match by match
PIECE = 48       # bytes of one match that are merged at once

SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        size = max(self.tokens, default=-1) + 1
        self.lengths = np.array([len(self.tokens.get(i, b"")) for i in range(size)], dtype=np.int64)
        # White space as the library has it: by the Unicode property.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pair_stays = functools.lru_cache(1 << 16)(self._pair_stays)

    # One match of the pattern, as bytes.

    def merge(self, piece: bytes) -> list[int]:
        """The merges in order of rank, leftmost first; for short pieces."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _pair_stays(self, a: int, b: int) -> bool:
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def join_piece(self, left: list[int], right: list[int]) -> list[int]:
        """Two encodings of neighbouring parts of one match as one encoding."""
        n = 1
        while True:
            i, j = max(0, len(left) - n), min(len(right), n)
            window = self._window(left[i:], right[:j])
            ends_hold = (i == 0 or self.pair_stays(left[i - 1], window[0])) and (
                j == len(right) or self.pair_stays(window[-1], right[j]))
            if ends_hold:
                return left[:i] + window + right[j:]
            n *= 2

    def _window(self, left: list[int], right: list[int]) -> list[int]:
        piece = b"".join(map(self.tokens.__getitem__, left + right))
        # A window that outgrows a leaf is reduced by itself, on other borders.
        return self.merge(piece) if len(piece) <= 2 * PIECE else self.merge_long(piece)

    def merge_long(self, piece: bytes) -> list[int]:
        """Merges with the pairs kept in a heap, for windows that had to grow far."""
        n = len(piece)
        after, before, end = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        live = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if not live[i] or j >= n or end[j] != e:
                continue
            end[i], live[j], after[i] = e, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := self.ranks.get(piece[i:end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if (k := before[i]) >= 0 and (r := self.ranks.get(piece[k:e])) is not None:
                heapq.heappush(heap, (r, k, e))
        return [self.ranks[piece[i:end[i]]] for i in range(n) if live[i]]

    def encode_piece(self, piece: bytes) -> list[int]:
        """One match: halves down to PIECE bytes, joined up the tree, level by level."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        level = [self.merge(piece[i:i + PIECE]) for i in range(0, len(piece), PIECE)]
        while len(level) > 1:
            level = [self.join_piece(*level[i:i + 2]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0]

    # Whole texts.

    def _leaf(self, text: str) -> np.ndarray:
        if len(text) <= WINDOW:
            return np.array(self.library.encode_ordinary(text), dtype=np.uint32)
        out: list[int] = []
        for m in self.pattern.finditer(text):
            out += self.encode_piece(m[0].encode())
        return np.array(out, dtype=np.uint32)

    def _drop(self, ids: np.ndarray, n_bytes: int, front: bool) -> np.ndarray:
        """`ids` without those of the first or last `n_bytes` bytes."""
        n = 16
        while True:
            part = self.lengths[ids[:n]] if front else self.lengths[ids[-n:][::-1]]
            sums = np.cumsum(part)
            at = int(np.searchsorted(sums, n_bytes)) + 1 if n_bytes else 0
            if at <= len(sums):
                return ids[at:] if front else ids[:len(ids) - at]
            n *= 2

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> np.ndarray:
        if end - start <= LEAF:
            return self._leaf(text[start:end])
        mid = (start + end) // 2
        left, right = self._encode(text, start, mid), self._encode(text, mid, end)
        p, q = _fixed_before(text, start, mid), _fixed_after(text, mid, end)
        if p == mid or q == mid:  # the border itself is one
            return np.concatenate([left, right])
        window = self._leaf(text[p:q])
        return np.concatenate([
            self._drop(left, len(text[p:mid].encode()), front=False), window,
            self._drop(right, len(text[mid:q].encode()), front=True)])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= 4 * LEAF:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def _fixed(text: str, at: int) -> bool:
    """A match border whatever surrounds it: no white space, then a space."""
    return text[at] == " " and not text[at - 1].isspace()


def _fixed_before(text: str, start: int, mid: int) -> int:
    """The last such place at or before `mid`, else `start`."""
    if mid > start and _fixed(text, mid):
        return mid
    at = mid
    while (at := text.rfind(" ", start + 1, at)) > start:
        if _fixed(text, at):
            return at
    return start


def _fixed_after(text: str, mid: int, end: int) -> int:
    """The first such place after `mid`, else `end`."""
    at = mid
    while 0 <= (at := text.find(" ", at + 1, end)):
        if _fixed(text, at):
            return at
    return end


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank, one token a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def codec(path: str, pattern: str) -> Codec:
    return once(("codec", path, pattern), lambda: Codec(read_ranks(path), pattern))


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, ids, decoded` of every text: ids as little-endian unsigned 32-bit integers.

    One row per input row, equal rows included. A null text counts as empty: no ids, no bytes;
    a null doc_id stays null. An empty table gives no rows. Other columns are not read. `path`
    names a rank file that every executor has.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            ids = [c.encode(t) for t in batch.column("text").to_pylist()]
            # Ids and bytes of a batch together are as large as its texts times a small number.
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                pa.array([c.decode(x) for x in ids], pa.binary())], schema=SCHEMA)

    bounded_batches(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return chosen.mapInArrow(work, "doc_id long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Number and hashes of ids and decoded bytes."""
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
