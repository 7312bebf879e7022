"""Data quality rules, their report and the gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED, FAILED = "PASSED", "FAILED"


class QualityGateFailed(RuntimeError):
    """At least one day broke a rule; the report has been written."""


def _status(ok: Column) -> Column:
    return F.when(ok, PASSED).otherwise(FAILED)


def expected_days(df: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Every day from `first` to `last`; by default from the first to the last day present."""
    ends = df.agg((first if first is not None else F.min("dt")).alias("a"),
                  (last if last is not None else F.max("dt")).alias("b"))
    return ends.where("a <= b").select(F.explode(F.sequence("a", "b")).alias("dt"))


def existence(df: DataFrame, days: DataFrame) -> DataFrame:
    """Row count per expected day; a day without rows is FAILED."""
    counts = df.groupBy("dt").agg(F.count("*").alias("_rows"))
    return (
        days.join(counts, "dt", "left")
        .withColumn("row_count", F.coalesce("_rows", F.lit(0)))
        .select("dt", "row_count", _status(F.col("row_count") > 0).alias("status")))


def null_counts(df: DataFrame, columns: Sequence[str], max_rate: float = 0.0) -> DataFrame:
    """Nulls per column, in one pass, against a largest allowed share."""
    one_row = df.agg(F.count("*").alias("row_count"), *[
        F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        one_row.unpivot("row_count", list(columns), "column_name", "null_count")
        .withColumn("null_rate", F.when(F.col("row_count") > 0,
                                        F.col("null_count") / F.col("row_count")))
        .withColumn("status", _status(F.coalesce("null_rate", F.lit(0.0)) <= max_rate)))


def out_of_range(ts: str, low: Column, high: Column) -> Column:
    """True where a time is set and lies outside [low, high]."""
    return F.coalesce((F.col(ts) < low) | (F.col(ts) > high), F.lit(False))


def timestamp_range(df: DataFrame, ts: str, low: Column, high: Column) -> DataFrame:
    """Rows per day with a time outside [low, high]."""
    return (
        df.groupBy("dt")
        .agg(F.count("*").alias("row_count"),
             F.count_if(out_of_range(ts, low, high)).alias("out_of_range"))
        .withColumn("status", _status(F.col("out_of_range") == 0)))


def report(df: DataFrame, days: DataFrame, required: Sequence[str], ts: str,
           low: Column, high: Column, max_null_rate: float = 0.0) -> DataFrame:
    """One row per expected day with the outcome of every rule, from one scan of `df`.

    The largest share of nulls holds for each required column by itself. `reason` names the
    first rule broken, and the columns that broke it, `checks` the rules that held.
    """
    nulls = {c: f"_null{i}" for i, c in enumerate(required)}
    measured = df.groupBy("dt").agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()],
        F.count_if(out_of_range(ts, low, high)).alias("out_of_range"))
    zero = F.lit(0).cast("long")
    joined = days.join(measured, "dt", "left").select(
        "dt", *[F.coalesce(c, zero).alias(c) for c in ("row_count", *nulls.values(), "out_of_range")])
    joined = joined.withColumn("null_count", sum((F.col(n) for n in nulls.values()), zero))
    rows = F.greatest(F.col("row_count"), F.lit(1))
    broken = F.array_compact(F.array(*[F.when(F.col(n) / rows > max_null_rate, c) for c, n in nulls.items()]))
    exists = F.col("row_count") > 0
    filled = F.size(broken) == 0
    in_range = F.col("out_of_range") == 0
    return joined.select(
        "dt",
        _status(exists & filled & in_range).alias("status"),
        F.when(~exists, "no rows")
        .when(~filled, F.concat(F.lit("too many nulls: "), F.array_join(broken, ", ")))
        .when(~in_range, "time out of range").alias("reason"),
        F.array_compact(F.array(
            F.when(exists, "existence"),
            F.when(exists & filled, "nulls"),
            F.when(exists & in_range, "time_range"))).alias("checks"),
        "row_count", "null_count", "out_of_range")


def require_passed(report_df: DataFrame) -> None:
    """Raises for a report with a failed day; call it after the report is stored."""
    bad = report_df.where(F.col("status") == FAILED).orderBy("dt").select("dt", "reason").take(5)
    if bad:
        raise QualityGateFailed("; ".join(f"{r.dt}: {r.reason}" for r in bad))
