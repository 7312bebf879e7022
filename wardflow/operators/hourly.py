"""Hourly arrival metrics, with and without the hours nobody arrived.

Everything downstream of these aggregates works at (sector, hour) grain: a sector has at
most 8,784 rows a year however many encounters it receives, so windows partitioned by
sector stay small. Raw rows are never put in a window partitioned by sector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.times import hours


def hourly_metrics_sparse(encounters: DataFrame) -> DataFrame:
    """Arrivals and mean acuity per sector and hour; no row for an hour without arrivals."""
    return (
        encounters
        .groupBy("sector_id", F.window("arrival_time", "1 hour").alias("w"))
        .agg(F.count("encounter_id").alias("arrivals_count"),
             F.avg("triage_level").alias("avg_triage_acuity"))
        .select(F.col("w.start").alias("window_start"), "arrivals_count", "avg_triage_acuity",
                F.to_date("w.start").alias("dt"), "sector_id")
    )


def fill_hours(df: DataFrame, keys: Sequence[str] = ("sector_id",), ts: str = "window_start",
               zero: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Adds the missing hours between the first and last row of each key.

    Columns in `zero` are 0 in an added hour, those in `carry` keep the value of the hour
    before, the rest are null. Each row emits the hours up to the next row of its key, so no
    calendar is built and nothing is joined.
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    until = F.coalesce(F.lead(ts).over(w) - hours(1), F.col(ts))
    spread = df.withColumn("_until", until).withColumn(
        "_hour", F.explode(F.sequence(F.col(ts), F.col("_until"), F.expr("INTERVAL 1 HOUR"))))

    def value(name: str) -> Column:
        if name == ts:
            return F.col("_hour").alias(name)
        if name in keys or name in carry:
            return F.col(name)
        real = F.when(F.col("_hour") == F.col(ts), F.col(name))
        return (F.coalesce(real, F.lit(0).cast(df.schema[name].dataType))
                if name in zero else real).alias(name)

    return spread.select(*[value(c) for c in df.columns])


def hourly_metrics_dense(sparse: DataFrame) -> DataFrame:
    """The sparse metrics with empty hours as count 0 and no acuity."""
    filled = fill_hours(sparse.drop("dt"), zero=["arrivals_count"])
    return filled.withColumn("dt", F.to_date("window_start")).select(*sparse.columns)


def hours_of_days(sparse: DataFrame, first_day: Column, last_day: Column,
                  before_hours: int, after_hours: int) -> DataFrame:
    """The dense metrics around a range of days, equal to the same rows of the full table.

    Only the partitions of that range are read for values. The extent of each sector comes
    from two columns of the whole metrics table, which has one row per sector and hour.
    """
    lo = first_day.cast("timestamp_ntz") - hours(before_hours)
    hi = last_day.cast("timestamp_ntz") + hours(23 + after_hours)
    extent = sparse.groupBy("sector_id").agg(
        F.min("window_start").alias("_first"), F.max("window_start").alias("_last"))
    start, stop = F.greatest("_first", lo), F.least("_last", hi)
    spine = extent.where(start <= stop).select(
        "sector_id",
        F.explode(F.sequence(start, stop, F.expr("INTERVAL 1 HOUR"))).alias("window_start"))
    near = sparse.where(F.col("dt").between(F.to_date(lo), F.to_date(hi))).drop("dt")
    return (
        spine.join(near, ["sector_id", "window_start"], "left")
        .withColumn("arrivals_count", F.coalesce("arrivals_count", F.lit(0)))
        .withColumn("dt", F.to_date("window_start"))
        .select(*sparse.columns)
    )
