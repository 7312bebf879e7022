"""Hourly metrics from a stream of encounters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardflow.operators.hourly import hourly_metrics_sparse
from wardflow.streaming.files import LATENESS


def hourly_metrics_stream(encounters: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The sparse hourly metrics; in append mode an hour comes out once the watermark is past
    its end. State is one count and sum per open hour and sector."""
    return hourly_metrics_sparse(encounters.withWatermark("arrival_time", lateness))
