"""Predictions against what happened, forecast error and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.times import hour_start
from wardflow.operators.features import HORIZONS


def predictions_long(predictions: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """One row per prediction and horizon, named '+1h', '+4h', '+24h'."""
    wide = [f"predicted_arrivals_h{h}" for h in horizons]
    keep = [c for c in predictions.columns if c not in wide]
    return (
        predictions.unpivot(keep, wide, "_column", "predicted_arrivals")
        .withColumn("horizon_h", F.regexp_extract("_column", r"(\d+)$", 1).cast("int"))
        .withColumn("horizon", F.format_string("+%dh", "horizon_h"))
        .drop("_column"))


def predicted_vs_actual(predictions: DataFrame, metrics: DataFrame,
                        horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Each prediction with the arrivals of the hour it was made for.

    A run during hour H predicts '+n h' for hour H + n.
    """
    long = predictions_long(predictions, horizons).withColumn(
        "target_hour", hour_start("prediction_ts") + F.make_dt_interval(hours=F.col("horizon_h")))
    actual = metrics.select(
        "sector_id", F.col("window_start").alias("target_hour"),
        F.col("arrivals_count").alias("actual_arrivals"))
    return long.join(actual, ["sector_id", "target_hour"], "inner")


def forecast_error(pairs: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """MAE, RMSE and MAPE. MAPE leaves out actual 0 and `skipped_zero` says how many those were."""
    actual, predicted = F.col("actual_arrivals"), F.col("predicted_arrivals")
    miss = F.abs(actual - predicted)
    return pairs.groupBy(*by).agg(
        F.count("*").alias("pairs"),
        F.count_if(actual == 0).alias("skipped_zero"),
        F.avg(miss).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.when(actual != 0, miss / F.abs(actual))).alias("mape"))


def drift_psi(baseline: DataFrame, current: DataFrame, columns: Sequence[str],
              bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index of each column between two sets of rows.

    Bins have equal width over the range of the baseline; values beyond it fall in the outer
    bins, or, if the baseline has one value only, in bins of their own. Both sides are reduced to counts per column and bin before they meet; a bin empty
    on both sides adds 0, so only bins that occur are needed.
    """
    def long(df: DataFrame) -> DataFrame:
        return (df.select(*[F.col(c).cast("double").alias(c) for c in columns])
                .unpivot([], list(columns), "feature", "value").where(F.col("value").isNotNull()))

    values = long(baseline).withColumn("_base", F.lit(1)).unionByName(
        long(current).withColumn("_base", F.lit(0)))
    span = long(baseline).groupBy("feature").agg(
        F.min("value").alias("_lo"), ((F.max("value") - F.min("value")) / bins).alias("_width"))
    # A flat baseline has three bins: below it, equal, above.
    place = F.when(F.col("_width") > 0, F.floor((F.col("value") - F.col("_lo")) / F.col("_width"))).otherwise(
        F.signum(F.col("value") - F.col("_lo")) + 1)
    # One row per named column, so the broadcast cannot grow with the data.
    counts = (
        values.join(F.broadcast(span), "feature")
        .withColumn("bin", F.least(F.lit(bins - 1), F.greatest(
            F.lit(0), F.coalesce(place, F.lit(0)))).cast("int"))
        .groupBy("feature", "bin")
        .agg(F.sum("_base").alias("_b"), F.sum(1 - F.col("_base")).alias("_c")))
    totals = counts.groupBy("feature").agg(F.sum("_b").alias("_bn"), F.sum("_c").alias("_cn"))
    b = F.greatest(F.col("_b") / F.col("_bn"), F.lit(floor))
    c = F.greatest(F.try_divide(F.col("_c"), F.col("_cn")), F.lit(floor))
    return (
        counts.join(totals, "feature")
        .groupBy("feature")
        .agg(F.sum((c - b) * F.ln(c / b)).alias("psi"),
             F.first("_bn").alias("baseline_rows"), F.first("_cn").alias("current_rows")))
