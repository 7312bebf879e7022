"""The two consumer views as of a given moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.numbers import round_numbers
from wardflow.functions.times import hours


def current_status(metrics: DataFrame, as_of: Column, window_hours: int = 2) -> DataFrame:
    """Hourly metrics that started within the last hours before `as_of`, and not after it.

    The day bound repeats the time bound on the partition column, so old days are not read.
    """
    since = as_of - hours(window_hours)
    return (metrics.where(F.col("window_start").between(since, as_of) & F.col("dt").between(F.to_date(since), F.to_date(as_of)))
            .select("sector_id", "window_start", "arrivals_count", "avg_triage_acuity"))


def forecast_today(predictions: DataFrame, as_of: Column) -> DataFrame:
    """The predictions of the day of `as_of`."""
    return (predictions.where(F.col("dt") == F.to_date(as_of))
            .select("sector_id", "predicted_arrivals_h1", "dt"))


def predictions_preview(predictions: DataFrame) -> DataFrame:
    """Predictions for reading: times as text, numbers to two places."""
    shown = predictions.withColumn("prediction_ts", F.date_format("prediction_ts", "yyyy-MM-dd HH:mm:ss"))
    return round_numbers(shown, 2)
