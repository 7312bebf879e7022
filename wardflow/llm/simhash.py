"""SimHash near-duplicates by a self-join of the binary trie over the fingerprints.

Pairs of trie nodes are walked down together. A pair carries the number of bits in which its two
prefixes differ and ends where that exceeds the budget. With a budget of 3 bits, one of the four
16-bit blocks of two linked fingerprints is equal, so the trie is built four times, over the four
rotations, and in each only nodes equal in the first 16 bits are paired with themselves: the rest
is found in another rotation. Below, the full budget holds.

The subtries under the first 16 bits are spread over tasks. A subtrie that is too large for one
is walked down further by Spark: its rows go to the pairs of child nodes they take part in. So no
task holds an unbounded group, and pairs of documents are never written: a task returns the
links as one edge from each fingerprint to the first of its local component. Nodes that share all
64 bits of one fingerprint, told apart by their others, are dealt to pairs of blocks of nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, stored
from wardflow.llm.graph import components

SEED = 42
BLOCKS = 4           # rotations; one block of two linked fingerprints is equal
BLOCK_BITS = 16
STEP = 6             # levels that a large subtrie is walked down at once
UNIT_LIMIT = 16384   # rows of a subtrie that one task walks
DIRECT = 64          # pairs of a node pair that are compared without walking on
CHUNK = 1 << 19      # node pairs that are held at once
_GOLDEN = 0x9E3779B97F4A7C15


def shingles(text: str, words: int) -> list[bytes]:
    """Word shingles, repeats included; fewer words give the whole sequence, none give none."""
    w = text.encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if len(w) <= words:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*(w[i:] for i in range(words)))))


def signature(text: str, words: int, n: int) -> list[int]:
    """`n` fingerprints: the first over the XXH64 of the shingles, the others over mixed ones."""
    found = shingles(text, words)
    if not found:
        return [0] * n
    h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in found], dtype=np.uint64)
    out = []
    for k in range(n):
        x = h if k == 0 else _mixed(h, k)
        ones = np.zeros(64, dtype=np.int64)
        for i in range(0, len(x), 1 << 16):
            bits = np.unpackbits(x[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * ones > len(x), bitorder="little").tobytes(), "little", signed=True))
    return out


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    x = h + np.uint64(_GOLDEN * k & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def fingerprints(docs: DataFrame, words: int = 3, n: int = 1) -> DataFrame:
    """`_id, _th, sig` per row; a null text counts as empty and has fingerprints of zero."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = [signature(t, words, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "_id": batch.column("_id"), "_th": batch.column("_th"), "sig": pa.array(sig, pa.list_(pa.int64()))})

    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_th"),
                       text.alias("text")).mapInArrow(work, "_id long, _th long, sig array<long>")


class Trie:
    """Rows of whole units, sorted by unit, side and value: walks all their tries at once and
    keeps the components of the nodes that it links."""

    def __init__(self, value: np.ndarray, node: np.ndarray, check: np.ndarray, budget: int, check_bits: int | None):
        self.value, self.check, self.budget, self.check_bits = value, check, budget, check_bits
        self.names, self.node = np.unique(node, return_inverse=True)
        self.root = np.arange(len(self.names))
        self._renew()

    def _renew(self) -> None:
        own = self.root[self.node]
        self.own, self.changes = own, np.concatenate([[0], np.cumsum(own[1:] != own[:-1])]) if len(own) else own

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.node[a], self.node[b]
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                break
            np.minimum.at(self.root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
        self._renew()

    def walk(self, pairs: np.ndarray, depth: int) -> None:
        """`pairs` has rows (first, end, first, end, differing bits) of two ranges of rows, each
        under one trie node at `depth`; equal ranges mean the node with itself."""
        stack = [(depth, pairs)]
        while stack:
            depth, p = stack.pop()
            p = self._open(p)
            p = self._compare(p, all_of=depth == 64)
            if not len(p):
                continue
            if len(p) > CHUNK:
                stack += [(depth, part) for part in np.array_split(p, 1 + len(p) // CHUNK)]
                continue
            stack.append((depth + 1, self._children(p, depth)))

    def _open(self, p: np.ndarray) -> np.ndarray:
        """Without pairs whose rows are all in one component already."""
        a, ae, b, be = p[:, 0], p[:, 1] - 1, p[:, 2], p[:, 3] - 1
        done = ((self.changes[a] == self.changes[ae]) & (self.changes[b] == self.changes[be])
                & (self.own[a] == self.own[b]))
        return p[~done]

    def _compare(self, p: np.ndarray, all_of: bool) -> np.ndarray:
        """Compares the rows of small pairs and returns the others."""
        n = p[:, 1] - p[:, 0]
        sizes = n * (p[:, 3] - p[:, 2])
        small = np.ones(len(p), bool) if all_of else sizes <= DIRECT
        todo = p[small]
        if all_of and len(todo):  # equal values may be many: tiles of bounded size
            todo = np.concatenate([todo[:0], *map(_tiles, todo)])
        n = todo[:, 1] - todo[:, 0]
        ends = np.cumsum(n * (todo[:, 3] - todo[:, 2]))
        start = 0
        while start < len(todo):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + 2 * CHUNK)))
            some = self._open(todo[start:stop])
            if len(some):
                self._pairs(some, some[:, 1] - some[:, 0], (some[:, 1] - some[:, 0]) * (some[:, 3] - some[:, 2]))
            start = stop
        return p[~small]

    def _pairs(self, p: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> None:
        of = np.repeat(np.arange(len(p)), sizes)
        k = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i, j = p[of, 0] + k % n[of], p[of, 2] + k // n[of]
        linked = np.bitwise_count(self.value[i] ^ self.value[j]) <= self.budget
        linked &= i != j
        if self.check_bits is not None:
            i, j = i[linked], j[linked]
            linked = np.bitwise_count(self.check[i] ^ self.check[j]).sum(axis=1) <= self.check_bits
        i, j = i[linked], j[linked]
        if len(i):
            self._unite(i, j)

    def _children(self, p: np.ndarray, depth: int) -> np.ndarray:
        ones = np.concatenate([[0], np.cumsum((self.value >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])

        def mid(first: np.ndarray, end: np.ndarray) -> np.ndarray:
            return end - (ones[end] - ones[first])

        a, ae, b, be, d = p.T
        am, bm = mid(a, ae), mid(b, be)
        itself = a == b
        kids = [np.stack(x, axis=1) for x in (
            (a, am, b, bm, d), (am, ae, bm, be, d), (a, am, bm, be, d + 1), (am, ae, b, bm, d + 1))]
        kids[3] = kids[3][~itself]  # the mirror of the one before
        found = np.concatenate(kids)
        single = (found[:, 0] == found[:, 2]) & (found[:, 1] - found[:, 0] == 1)
        return found[(found[:, 0] < found[:, 1]) & (found[:, 2] < found[:, 3]) & (found[:, 4] <= self.budget) & ~single]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = self.root != np.arange(len(self.root))
        return self.names[moved], self.names[self.root[moved]]


def _tiles(p: np.ndarray, side: int = 512) -> np.ndarray:
    a, b = np.arange(p[0], p[1], side), np.arange(p[2], p[3], side)
    i, j = (x.ravel() for x in np.meshgrid(a, b, indexing="ij"))
    return np.stack([i, np.minimum(i + side, p[1]), j, np.minimum(j + side, p[3]), np.full(len(i), p[4])], axis=1)


_UNIT = ["_t", "_a", "_b"]
_ROW = [*_UNIT, "_side", "_d", "_v", "_node", "_c0", "_c1"]


def _top(value: str) -> Column:
    return F.shiftrightunsigned(value, 64 - BLOCK_BITS)


def _first_units(rows: DataFrame) -> DataFrame:
    """Rows of the subtries under the first bits, as units of a node with itself. What follows
    from the other columns is added after the shuffle."""
    return rows.select("_t", _top("_v").alias("_a"), _top("_v").alias("_b"), F.lit(0).alias("_side"), F.lit(0).alias("_d"),
                       "_v", "_node", "_c0", "_c1")


def _walk_units(dealt: DataFrame, depth: int, budget: int, check_bits: int | None) -> DataFrame:
    """Edges `u, v` found in units, each of which fits one task; `dealt` has the rows of a unit in
    one partition."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        unit = np.stack([t[c].to_numpy() for c in _UNIT], axis=1)
        side, d = t["_side"].to_numpy(), t["_d"].to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]).any(axis=1) | (side[1:] != side[:-1])]))
        end = np.append(new[1:], len(unit))
        check = np.stack([t["_c0"].to_numpy().view(np.uint64), t["_c1"].to_numpy().view(np.uint64)], axis=1)
        trie = Trie(t["_v"].to_numpy().view(np.uint64), t["_node"].to_numpy(), check, budget, check_bits)
        pairs = [np.stack([new, end, new, end, d[new]], axis=1)[(side[new] == 0) & (end - new > 1)]]
        first, second = np.flatnonzero(side[new][:-1] == 1), np.flatnonzero(side[new][1:] == 2) + 1
        first = first[np.isin(first + 1, second)]
        first = first[(unit[new[first]] == unit[new[first + 1]]).all(axis=1)]
        pairs.append(np.stack([new[first], end[first], new[first + 1], end[first + 1], d[new[first]]], axis=1))
        trie.walk(np.concatenate(pairs).astype(np.int64), depth)
        u, v = trie.edges()
        for i in range(0, len(u), 1 << 16):
            yield pa.RecordBatch.from_pydict({"u": u[i:i + (1 << 16)], "v": v[i:i + (1 << 16)]})

    return dealt.select(*_ROW).sortWithinPartitions(*_UNIT, "_side", F.col("_v") < 0, "_v").mapInArrow(work, "u long, v long")


def _split(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """Rows of large units dealt to the pairs of nodes STEP levels further down."""
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("n"))
                      for m in range(1 << STEP) if m.bit_count() <= budget])
    sub = F.shiftrightunsigned("_v", 64 - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1))
    dealt = (rows.withColumn("_s", sub)
             .withColumn("_m", F.explode(F.filter(masks, lambda x: x["n"] + F.col("_d") <= budget)))
             .withColumn("_o", F.col("_s").bitwiseXOR(F.col("_m.m"))))
    own, other = F.col("_s"), F.col("_o")
    itself = F.col("_side") == 0
    ours_first = F.when(itself, own <= other).otherwise(F.col("_side") == 1)
    # Shifts, not products: a prefix of 58 bits or more may leave the positive range.
    return dealt.select(
        "_t",
        F.shiftleft("_a", STEP).bitwiseOR(F.when(ours_first, own).otherwise(other)).alias("_a"),
        F.shiftleft("_b", STEP).bitwiseOR(F.when(ours_first, other).otherwise(own)).alias("_b"),
        F.when(itself, F.when(own == other, 0).when(own < other, 1).otherwise(2)).otherwise(F.col("_side")).alias("_side"),
        (F.col("_d") + F.col("_m.n")).alias("_d"), "_v", "_node", "_c0", "_c1")


def _whole_values(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Of units whose sides are one value each: edges `u, v` between nodes equal in the check bits
    too, and units of about `limit` rows that have every pair of the others.

    The first of the equal nodes stands for them. What is still too large is dealt by a hash of
    the node to blocks, and each two blocks are a unit.
    """
    same = [*_UNIT, "_side", "_d", "_v", "_c0", "_c1"]
    firsts = stored(rows.groupBy(*same).agg(F.min("_node").alias("_node")))
    equal = rows.join(firsts.withColumnRenamed("_node", "_first"), same).where(
        F.col("_node") != F.col("_first")).select(F.col("_node").alias("u"), F.col("_first").alias("v"))
    sizes = stored(firsts.groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("_size"))
                   .withColumn("_q", F.monotonically_increasing_id())
                   .withColumn("_blocks", F.when(F.col("_size") <= limit, 1).otherwise(F.ceil(2 * F.col("_size") / limit)).cast("int")))
    dealt = (firsts.join(sizes, _UNIT)
             .withColumn("_h", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    own, other = F.col("_h"), F.col("_o")
    ours_first = F.when(F.col("_side") == 0, own <= other).otherwise(F.col("_side") == 1)
    return equal, dealt.select(
        F.col("_q").alias("_t"),
        F.when(ours_first, own).otherwise(other).cast("long").alias("_a"),
        F.when(ours_first, other).otherwise(own).cast("long").alias("_b"),
        F.when(F.col("_side") == 0, F.when(own == other, 0).when(own < other, 1).otherwise(2))
        .otherwise(F.col("_side")).alias("_side"), "_d", "_v", "_node", "_c0", "_c1")


def links(nodes: DataFrame, budget: int = 3, check_bits: int | None = None, limit: int = UNIT_LIMIT) -> DataFrame:
    """Edges `u, v` that connect all of `nodes(_node, sig)` whose fingerprints differ in
    `budget` bits or fewer in any place of `sig`, and, if `check_bits` is given, in at most so
    many bits of the first two places together."""
    if budget >= BLOCKS:
        raise ValueError(f"a budget of {budget} bits needs more than {BLOCKS} blocks")
    check = [F.get("sig", k) if check_bits is not None else F.lit(0).cast("long") for k in (0, 1)]
    rows = nodes.select("_node", check[0].alias("_c0"), check[1].alias("_c1"), F.posexplode("sig").alias("_k", "_f")).select(
        "_node", "_c0", "_c1", "_k", F.posexplode(F.array(*[
            F.shiftleft("_f", BLOCK_BITS * r).bitwiseOR(F.shiftrightunsigned("_f", 64 - BLOCK_BITS * r)) if r else F.col("_f")
            for r in range(BLOCKS)])).alias("_r", "_v")).select(
        (F.col("_k") * BLOCKS + F.col("_r")).alias("_t"), "_v", "_node", "_c0", "_c1")
    unit = (F.shiftleft(F.col("_t").cast("long"), BLOCK_BITS) + _top("_v")).alias("_u")
    large = stored(rows.groupBy(unit).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("_u"))
    if large.isEmpty():
        return _walk_units(_first_units(rows.repartition("_t", _top("_v"))), BLOCK_BITS, budget, check_bits)
    marked = rows.withColumn("_u", unit)
    small = marked.join(large, "_u", "left_anti").drop("_u")
    depth, found = BLOCK_BITS, [_walk_units(_first_units(small.repartition("_t", _top("_v"))), BLOCK_BITS, budget, check_bits)]
    rows = stored(_first_units(marked.join(large, "_u")))
    while True:
        rows = stored(_split(rows, depth, budget))
        depth += STEP
        sides = rows.groupBy(*_UNIT).agg(*[F.count_if(F.col("_side") == k).alias(f"n{k}") for k in range(3)])
        large = stored(sides.where((F.col("n0") + F.col("n1") + F.col("n2") > limit)
                                   & ((F.col("n0") > 1) | (F.col("n1") > 0) & (F.col("n2") > 0))).select(*_UNIT))
        if large.isEmpty():
            found.append(_walk_units(rows.repartition(*_UNIT), depth, budget, check_bits))
            break
        found.append(_walk_units(rows.join(large, _UNIT, "left_anti").repartition(*_UNIT), depth, budget, check_bits))
        rows = rows.join(large, _UNIT)
        if depth == 64:
            equal, tiled = _whole_values(stored(rows), limit)
            found += [equal, _walk_units(tiled.repartition(*_UNIT), depth, budget, check_bits)]
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def grouped(docs: DataFrame, words: int = 3, n: int = 1, budget: int = 3,
            check_bits: int | None = None, limit: int = UNIT_LIMIT) -> DataFrame:
    """Rows of near_duplicates with `component`, a number for each component: components may
    share their smallest doc_id, or have none."""
    rows = stored(fingerprints(docs, words, n))
    nodes = stored(rows.groupBy("sig").agg(F.min("_id").alias("_first"))
                   .withColumn("_node", F.monotonically_increasing_id()))
    groups = components(links(nodes, budget, check_bits, limit))
    placed = nodes.join(groups, nodes["_node"] == groups["node"], "left").select(
        "sig", "_first", F.coalesce("component", "_node").alias("component"))
    firsts = placed.groupBy("component").agg(F.min("_first").alias("component_id"))
    named = placed.join(firsts, "component").select("sig", "component", "component_id")
    return rows.join(stored(named), "sig")


def near_duplicates(docs: DataFrame, words: int = 3, n: int = 1, budget: int = 3,
                    check_bits: int | None = None, limit: int = UNIT_LIMIT) -> DataFrame:
    """`_id, _th, sig, component_id` for each row of `docs(doc_id, text)`: rows linked by
    fingerprints, or by links of links, share the smallest doc_id among them.

    Rows with equal fingerprints are one node, however many they are. A null text counts as
    empty; texts without words have the fingerprint zero and are linked like any others. A null
    doc_id stays null and counts only if its component has no other. Equal rows give equal
    rows; an empty table gives none; other columns are not read.
    """
    return grouped(docs, words, n, budget, check_bits, limit).drop("component")


def keep_one(docs: DataFrame, words: int = 2, n: int = 8, budget: int = 3, check_bits: int | None = 15) -> DataFrame:
    """`docs` with one row of each group of near copies: the one with the smallest doc_id (null
    last), then text hash. Groups are told apart by their texts, whatever doc_ids they share.

    Several fingerprints per text find near copies that one would miss; the bits of two of them
    together decide. Fingerprints are over 2-word shingles, which an edited word changes less:
    15 differing bits of 128 stand for a similarity of about 0.8 over 5-word shingles. Of rows
    equal in doc_id and text, one stays.
    """
    groups = grouped(docs, words, n, budget, check_bits)
    first = groups.where(F.col("_id").eqNullSafe(F.col("component_id"))).groupBy("component", "_id").agg(
        F.min("_th").alias("_th"))
    return only(docs, first)


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id and text hash are in `kept(_id, _th)`, each once.

    A null doc_id is written as two columns that are not null: so the join and the choice among
    equal rows agree on their keys, and texts are shuffled once for both.
    """
    def keys(doc_id: Column, th: Column) -> list[Column]:
        return [F.coalesce(doc_id.cast("long"), F.lit(0)).alias("_keep_id"),
                F.isnull(doc_id).cast("int").alias("_keep_null"), th.alias("_keep_th")]

    names = ["_keep_id", "_keep_null", "_keep_th"]
    th = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    found = docs.select("*", *keys(F.col("doc_id"), th)).join(
        kept.select(*keys(F.col("_id"), F.col("_th"))), names, "left_semi")
    return found.dropDuplicates(names).select(*[F.col(f"`{c}`") for c in docs.columns])
