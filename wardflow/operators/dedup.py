"""Deterministic removal of repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order`, then by every other column that can be sorted.

    The rank limit is applied before the shuffle as well as after it, so a key that holds a
    large share of the rows reaches its reducer as one row per map task. Null keys count as
    one key.
    """
    used = set(keys) | set(order)
    rest = [f.name for f in df.schema
            if f.name not in used and not isinstance(f.dataType, (MapType, VariantType))]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_group(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The last row by `ts` of each group; equal times are settled by the other columns.

    A rank, not max_by over a struct: the rank limit runs on both sides of the shuffle.
    """
    rest = [f.name for f in df.schema if f.name not in {*keys, ts}]
    w = Window.partitionBy(*keys).orderBy(
        F.col(ts).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
