"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows of the scan's partitions are counted; the driver draws how many rows of each cell (some
partitions together) go to each shard, such that every outcome is as likely as if all rows were
dealt at random. Each cell permutes its rows' shards, the rows are exchanged, and each shard
orders them by a random key. Shards are cut into blocks of bounded size for that, so no task
holds a whole shard.

Random numbers depend on the seed and the cell only: a lost task makes the same ones again.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, stored

SHARDS = 24
SEED = 20
CELLS = 4096             # rows of the matrix at most
BLOCK_ROWS = 4_000       # mean rows of a block of a shard
_KEY_BITS = 62
_INDEX_BITS = 33         # of the row index in monotonically_increasing_id


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` drawn without return are good."""
    if min(good, n) == 0 or bad == 0 or n == good + bad:
        return min(good, n)
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    # Beyond the library's range: probabilities by their ratios, 12 deviations around the mean.
    total = good + bad
    mean = n * good / total
    sd = math.sqrt(mean * (bad / total) * ((total - n) / (total - 1)))
    low, high = max(0, n - bad, int(mean - 12 * sd) - 2), min(good, n, int(mean + 12 * sd) + 2)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(p, rng.random() * p[-1]))


def matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of each cell that go to each shard; the sums over cells differ by one at most."""
    total = sum(rows)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng([seed])
    out = np.zeros((len(rows), shards), dtype=np.int64)
    for c, n in enumerate(rows):
        rest = sum(left)
        for s in range(shards):
            rest -= left[s]
            out[c, s] = hypergeometric(rng, left[s], rest, n)
            left[s] -= int(out[c, s])
            n -= int(out[c, s])
    return out


@functools.lru_cache(2)
def _dealt(seed: int, cell: int, row: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Shard and random key of each row of a cell."""
    rng = np.random.default_rng([seed, 1, cell])
    shard = rng.permutation(np.repeat(np.arange(len(row), dtype=np.int16), row))
    return shard, rng.integers(0, 1 << _KEY_BITS, size=len(shard), dtype=np.int64)


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, cells: int = CELLS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`docs` with `shard` and `slot`: shards 0 to `shards - 1` whose sizes differ by one at
    most, slots from 0 without a gap, all outcomes equally likely.

    `docs` is read several times and should be a stored table: if its partitions have other rows
    the second time, the job fails. Every row counts by itself, whatever it holds, equal ones
    too; an empty table gives no rows. Columns shard and slot of `docs` are replaced.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("shard", "slot")
    pid = F.spark_partition_id()
    sizes = {r.p: r.n for r in docs.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_parts = max(sizes, default=-1) + 1
    each = max(1, -(-n_parts // cells))  # partitions of one cell
    n_of = np.array([sizes.get(p, 0) for p in range(n_parts)], dtype=np.int64)
    before = np.cumsum(n_of) - n_of
    per_cell = [int(n_of[i:i + each].sum()) for i in range(0, n_parts, each)]
    # 8 bytes for each partition of the scan, and `cells` rows of the matrix, go to the tasks.
    offset = before - before[np.arange(n_parts) // each * each] if n_parts else before
    drawn = matrix(per_cell, shards, seed)

    def deal(p: pd.Series, i: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"shard": np.zeros(len(p), np.int32), "key": np.zeros(len(p), np.int64)})
        for part in p.unique():
            at = (p == part).to_numpy()
            index = i[at].to_numpy()
            if part >= len(n_of) or index.max() >= n_of[part]:
                raise RuntimeError("the table changed between two reads; give a stored one")
            shard, key = _dealt(seed, int(part) // each, tuple(drawn[part // each].tolist()))
            out.loc[at, "shard"] = shard[offset[part] + index].astype(np.int32)
            out.loc[at, "key"] = key[offset[part] + index]
        return out

    dealer = F.pandas_udf(deal, "shard int, key long")
    bits = max(0, math.ceil(math.log2(max(1, int(n_of.sum()) / shards / block_rows))))

    def dealt(df: DataFrame) -> DataFrame:
        numbered = df.withColumn("_p", pid).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(
            F.lit((1 << _INDEX_BITS) - 1)))
        return numbered.withColumn("_to", dealer("_p", "_i")).withColumn("shard", F.col("_to.shard")).withColumn(
            "_key", F.col("_to.key")).withColumn("_block", F.shiftright("_key", _KEY_BITS - bits))

    counts = dealt(docs.select()).groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy("shard").orderBy("_block")
    starts = stored(counts.withColumn("_start", F.sum("_n").over(w) - F.col("_n")).drop("_n"))
    order = W.partitionBy("shard", "_block").orderBy("_key", "_p", "_i")
    return (
        dealt(docs).join(starts, ["shard", "_block"])
        .withColumn("slot", (F.col("_start") + F.row_number().over(order) - 1).cast("long"))
        .drop("_p", "_i", "_to", "_key", "_block", "_start"))


def write(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes the rows of `docs` with their slot to folders shard=0, shard=1 and so on."""
    assign(docs, shards, seed).write.partitionBy("shard").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("shard", F.col("shard").cast("int"))
