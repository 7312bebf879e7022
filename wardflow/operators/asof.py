"""The latest row at or before a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.times import hour_start, hours


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              values: Sequence[str],
              settle: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """`left` with `values` of the last `right` row of the same key at or before `left_ts`.

    `right` is a table written on a schedule (a few rows per key and hour); `left` may be raw
    events with any skew and is never put in a window. Each right row holds from its own time
    to the next one's, cut at full hours, so an equi-join on (key, hour) plus the interval
    test finds exactly one row: Spark may broadcast the right side if small, or split a hot
    (key, hour) of the left side as join skew. Hours in which `left` has rows but `right` has
    none get the value carried over; hours without left rows cost nothing.
    Of several right rows with one time, the one with the largest values counts.

    `settle` is applied to the cut right side before the join. With lake.stored its true size
    is known, and while it is small enough to broadcast, `left` is not shuffled at all.
    """
    payload = F.struct(*values)
    own = (right.where(F.col(right_ts).isNotNull())
           .groupBy(key, F.col(right_ts).alias("_from")).agg(F.max(payload).alias("_row"))
           .select(key, hour_start("_from").alias("_hour"), "_from", "_row"))
    opening = (
        left.where(F.col(left_ts).isNotNull())
        .select(key, hour_start(left_ts).alias("_hour"))
        .unionByName(own.select(key, "_hour")).distinct()
        .select(key, "_hour", F.col("_hour").alias("_from"),
                F.lit(None).cast(own.schema["_row"].dataType).alias("_row")))
    # An opening row sorts before a right row of the very same instant.
    ordered = Window.partitionBy(key).orderBy("_from", F.col("_row").isNotNull())
    pieces = (
        opening.unionByName(own)
        .withColumn("_value", F.last("_row", ignorenulls=True).over(
            ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_to", F.least(
            F.coalesce(F.lead("_from").over(ordered), F.col("_hour") + hours(1)),
            F.col("_hour") + hours(1)))
        .where((F.col("_from") < F.col("_to")) & F.col("_value").isNotNull())
        .select(F.col(key).alias("_key"), "_hour", "_from", "_to", "_value"))
    pieces = settle(pieces)
    probe = left.withColumn("_at", hour_start(left_ts))
    matched = probe.join(
        pieces,
        (probe[key] == pieces["_key"]) & (probe["_at"] == pieces["_hour"])
        & (probe[left_ts] >= pieces["_from"]) & (probe[left_ts] < pieces["_to"]),
        "left")
    return matched.select(*left.columns, *[F.col(f"_value.{v}").alias(v) for v in values])
