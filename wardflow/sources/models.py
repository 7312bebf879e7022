"""Versioned model folders and the registry table that lists them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.schemas import MODEL_REGISTRY
from wardflow.sources.lake import EmptyInput


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/artifacts"


def save_models(spark: SparkSession, root: str, version: str, models: dict[int, PipelineModel],
                errors: DataFrame, trained_on: int) -> None:
    """Writes each model to its own folder, then registers the version.

    `errors` has one row per horizon (see forecast.over_origins). The registry row comes
    last, so a version that can be found is complete.
    """
    for h, model in models.items():
        model.write().overwrite().save(f"{_base(root)}/models/{version}/h{h}")
    rows = errors.select(
        F.lit(version).alias("version"), F.col("horizon").cast("int").alias("horizon"),
        F.format_string(f"{_base(root)}/models/{version}/h%d", "horizon").alias("path"),
        "mae", "rmse", "mape", "naive_mae", F.lit(trained_on).cast("long").alias("trained_on"),
        (F.col("mae") <= F.col("naive_mae")).alias("beats_naive"), "origins", "mae_sd")
    rows.coalesce(1).write.mode("append").parquet(f"{_base(root)}/registry")


def registry(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MODEL_REGISTRY).parquet(f"{_base(root)}/registry")
    except AnalysisException as e:
        raise EmptyInput("no model has been registered") from e


def load_latest(spark: SparkSession, root: str) -> tuple[str, dict[int, PipelineModel]]:
    """The newest version and its models by horizon."""
    known = registry(spark, root)
    # A version has one row per horizon.
    newest = known.where(F.col("version") == known.agg(F.max("version")).scalar()).select(
        "version", "horizon", "path").distinct().collect()
    if not newest:
        raise EmptyInput("no model has been registered")
    return newest[0].version, {r.horizon: PipelineModel.load(r.path) for r in sorted(newest, key=lambda r: r.horizon)}
