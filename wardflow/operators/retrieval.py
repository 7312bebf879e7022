"""Exact top-k search by cosine similarity.

Queries are a batch and the corpus is large, so the corpus stays where it is. Queries go to the
tasks in slices of a bounded size, one pass over the corpus each. The queries of a slice have
centroids; a task sorts each Arrow batch by nearest centroid and, by the triangle inequality,
skips every query that no row of such a group can reach any more, given the k best the task
holds for it so far. Only k rows per task and query are shuffled. There is one plan for any
number of queries.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from wardflow.functions.vectors import cosine
from wardflow.session import bounded_batches, run_dir
from wardflow.sources.lake import no_rows, stored

PLACES = 9  # similarities equal to this many places are ties, settled by id
SLACK = 1e-8  # by which a bound may be off, from rounding and floating point
SCORES = 1_000_000  # numbers held at once by one matrix product
SLICE = 4_000_000  # numbers in the vectors of one slice of queries: 32 MB
ROUNDS = 4  # of moving the centroids


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    sizes = pc.list_value_length(vectors).to_numpy()
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError("vectors must be of one length")
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), sizes[0] if len(sizes) else 0)
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def _places(q: np.ndarray) -> np.ndarray:
    """The position of each element within its run of equal values."""
    starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1]
    return np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _centres(units: np.ndarray) -> np.ndarray:
    """About sqrt(n) centroids of the rows, so that finding the nearest one costs little
    beside scoring; which ones decides the speed alone."""
    n = math.isqrt(len(units) - 1) + 1
    centres = units[np.linspace(0, len(units) - 1, n).astype(int)]
    for _ in range(ROUNDS):
        near = _distances(units, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        counts = np.bincount(near, minlength=n)[:, None]
        centres = np.divide(sums, counts, out=centres.copy(), where=counts > 0)
    return centres


class _Best:
    """The k best candidates of every query so far, by similarity and then id."""

    def __init__(self, queries: int, k: int, floor: float):
        self.k, self.floor = k, floor
        self.sims = np.full((queries, k), -np.inf)
        self.ids = None
        self.limit = np.full(queries, floor)  # a candidate below it is none

    def add(self, q: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        if not len(q):
            return
        if self.ids is None:
            self.ids = np.empty(self.sims.shape, dtype=ids.dtype)
        touched = np.unique(q)
        old = np.repeat(touched, self.k), self.ids[touched].ravel(), self.sims[touched].ravel()
        known = old[2] > -np.inf
        q, ids, sims = (np.concatenate([a[known], b]) for a, b in zip(old, (q, ids, sims)))
        order = np.lexsort((ids, -sims, q))
        q, ids, sims = q[order], ids[order], sims[order]
        place = _places(q)
        kept = place < self.k
        self.sims[q[kept], place[kept]] = sims[kept]
        self.ids[q[kept], place[kept]] = ids[kept]
        self.limit[touched] = np.maximum(self.sims[touched, -1], self.floor)


def _score(best: _Best, live: np.ndarray, units: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
    """Offers the rows to the live queries."""
    sims = np.round(units[live] @ rows.T, PLACES) + 0.0
    cut = best.limit[live].copy()
    new = np.isneginf(cut)
    if new.any() and len(ids) > best.k:
        cut[new] = np.partition(sims[new], len(ids) - best.k, axis=1)[:, len(ids) - best.k]
    q, col = np.nonzero(sims >= cut[:, None])
    best.add(live[q], ids[col], sims[q, col])


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64 if pa.types.is_integer(column.type) else object)


def _top_k_of(batches: Iterator[pa.RecordBatch], query_ids: np.ndarray, units: np.ndarray, centres: np.ndarray,
              corpus_id: str, vector: str, k: int, floor: float, rows_at_once: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The best k rows of all batches per query, and one row with the pairs met and scored."""
    best, met, scored = _Best(len(units), k, floor), 0, 0
    to_centre = _distances(units, centres)
    home = to_centre.argmin(1)
    for some in (b.slice(at, rows_at_once) for b in batches for at in range(0, b.num_rows, rows_at_once)):
        met += some.num_rows * len(units)
        every, ids = _unit_rows(some.column(vector)), _ids(some.column(corpus_id))
        away = _distances(every, centres)
        near = away.argmin(1)
        order = np.argsort(near, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(near[order])) + 1)
        # Each query meets the rows around its own centroid first: most others are then out of reach.
        for own, group in [(True, g) for g in groups] + [(False, g) for g in groups]:
            c = near[group[0]]
            asked = (home == c) == own
            at = 0
            while at < len(group):
                radius = away[group[at:], c]
                # A row is at least this far from a query, and similarity is 1 - distance² / 2.
                gap = np.maximum(np.maximum(to_centre[:, c] - radius.max(), radius.min() - to_centre[:, c]), 0)
                live = np.flatnonzero(asked & (1 - gap * gap / 2 >= best.limit - SLACK))
                if not len(live):
                    break
                step = max(1, min(rows_at_once, SCORES // len(live)))
                part = group[at:at + step]
                _score(best, live, units, every[part], ids[part])
                scored += len(part) * len(live)
                at += step
    q, place = np.nonzero(best.sims > -np.inf)
    n = len(q)
    yield pa.RecordBatch.from_pydict({
        "query_id": [*query_ids[q].tolist(), None], "corpus_id": [*(best.ids[q, place].tolist() if n else []), None],
        "similarity": pa.array([*best.sims[q, place].tolist(), None], pa.float64()),
        "pairs": pa.array([None] * n + [met], pa.int64()), "scored": pa.array([None] * n + [scored], pa.int64())}, schema=schema)


def top_k_with_report(corpus: DataFrame, queries: DataFrame, k: int = 3, *, corpus_id: str, query_id: str,
                      vector: str = "vector", max_broadcast_queries: int | None = None,
                      corpus_block_rows: int = 2_500, above: float | None = None) -> tuple[DataFrame, DataFrame]:
    """The hits of `top_k_similar`, and one row `pairs, scored`: the pairs of a query and a
    corpus row, and how many of them had to be compared."""
    # Rows without a vector are no neighbours; queries without one have none.
    corpus = corpus.select(corpus_id, vector).where(F.col(vector).isNotNull())
    queries = queries.where(F.col(vector).isNotNull())
    queries = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("_query"))
    out = (StructType()
           .add("query_id", queries.schema["query_id"].dataType)
           .add("corpus_id", corpus.schema[corpus_id].dataType)
           .add("similarity", DoubleType()).add("pairs", LongType()).add("scored", LongType()))
    for f in (out["query_id"], out["corpus_id"]):
        if not isinstance(f.dataType, (LongType, StringType)):
            raise TypeError(f"{f.name} must be a string or a long")

    spark = corpus.sparkSession
    queries = stored(queries)
    n, dims = queries.agg(F.count(F.lit(1)), F.max(F.size("_query"))).first()
    most = max_broadcast_queries or max(1, SLICE // max(1, dims or 1))
    # Slices by hash are not equal in size: on average they are half of what is allowed.
    slices = max(1, math.ceil(2 * n / most)) if n > most else 1
    path, floor = run_dir(spark, "top-k"), -np.inf if above is None else above
    no_rows(spark, out).write.parquet(path)
    bounded_batches(spark)
    arrow = to_arrow_schema(out)
    for i in range(slices):
        held = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(slices)) == i).toArrow().combine_chunks()
        if not held.num_rows:
            continue
        units = _unit_rows(held["_query"].combine_chunks())
        # One broadcast for all tasks, not a copy in every task's closure.
        shared = spark.sparkContext.broadcast((_ids(held["query_id"]), units, _centres(units)))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from _top_k_of(batches, *shared.value, corpus_id, vector, k, floor, corpus_block_rows, arrow)

        corpus.mapInArrow(score, out).write.mode("append").parquet(path)
        shared.destroy()

    found = spark.read.schema(out).parquet(path)
    hits = found.where(F.col("query_id").isNotNull())
    if above is not None:
        hits = hits.where(F.col("similarity") > above)
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("corpus_id"))
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "corpus_id", "similarity"),
            found.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
                      F.coalesce(F.sum("scored"), F.lit(0)).alias("scored")))


def top_k_similar(corpus: DataFrame, queries: DataFrame, k: int = 3, **options) -> DataFrame:
    """`query_id, rank, corpus_id, similarity` with the k most similar corpus rows per query.

    Ids must be unique and be strings or longs; options are those of `top_k_with_report`. The driver
    holds about `max_broadcast_queries` queries at a time. A vector of zeros has similarity 0 to all;
    `above` leaves out hits that are not more similar than it, so with 0 such queries have none.
    """
    return top_k_with_report(corpus, queries, k, **options)[0]


def centroids(df: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """The mean vector of each group; partial sums are merged, so group size does not matter."""
    return df.groupBy(group).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias(vector))


def similarity_to_group(df: DataFrame, group: str, vector: str = "vector",
                        settle: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Each row with the cosine of its vector to the mean of its group.

    One mean per group meets each row once. `settle` is applied to the means: with lake.stored
    Spark knows their size, broadcasts them while small and else splits a hot group as skew.
    """
    means = settle(centroids(df, group, vector).withColumnRenamed(vector, "_mean"))
    return df.join(means, group).withColumn("similarity", cosine(vector, "_mean")).drop("_mean")


def with_context(hits: DataFrame, corpus: DataFrame, corpus_id: str) -> DataFrame:
    """Per query: its chunks in rank order joined by a blank line, and their sources once each
    in the same order. Groups hold k rows.

    Pass hits that were stored (lake.stored): their size is then known to be small, and the
    corpus is scanned, not shuffled, and the search is not run again.
    """
    found = hits.join(corpus, hits["corpus_id"] == corpus[corpus_id])
    ordered = F.array_sort(F.collect_list(F.struct("rank", "source", "text")))
    return found.groupBy("query_id").agg(ordered.alias("_hits")).select(
        "query_id",
        F.array_join(F.transform("_hits", lambda h: h["text"]), "\n\n").alias("context"),
        F.array_distinct(F.transform("_hits", lambda h: h["source"])).alias("citations"))
