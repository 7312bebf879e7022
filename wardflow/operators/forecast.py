"""Gradient-boosted arrival forecasts per horizon, and the naive forecast to beat."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.times import version_stamp
from wardflow.operators.dedup import latest_per_group
from wardflow.operators.features import FEATURES, HORIZONS

KEY = ("sector_id", "prediction_ts", "model_version")


def split_by_time(features: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Hours before the cutoff for training, the rest held out."""
    return features.where(F.col("window_start") < cutoff), features.where(F.col("window_start") >= cutoff)


def known_before(features: DataFrame, origin: Column, horizon: int) -> DataFrame:
    """The hours whose target hour was over at the origin: a gap of the horizon keeps labels of
    held-out hours out of training."""
    return features.where(F.col("window_start") + F.make_dt_interval(hours=F.lit(horizon)) < origin)


def fit_horizon(train: DataFrame, horizon: int, *, max_iter: int = 20, max_depth: int = 3,
                seed: int = 42) -> PipelineModel:
    """Boosted trees from the features to the arrivals `horizon` hours ahead.

    Every tree level is a job over all partitions, so the training rows, an hourly table in
    many small files, are first brought to partitions of a sensible size.
    """
    target = f"target_arrivals_h{horizon}"
    columns = [F.col(c).cast("double").alias(c) for c in (*FEATURES, target)]
    known = train.where(F.col(target).isNotNull()).select(*columns).hint("rebalance")
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="x"),
        GBTRegressor(featuresCol="x", labelCol=target,
                     predictionCol=f"predicted_arrivals_h{horizon}",
                     maxIter=max_iter, maxDepth=max_depth, seed=seed),
    ]).fit(known)


def fit_horizons(train: DataFrame, horizons: Sequence[int] = HORIZONS, origin: Column | None = None,
                 **options) -> dict[int, PipelineModel]:
    """One model per horizon; with an origin each learns only what was known before it."""
    return {h: fit_horizon(train if origin is None else known_before(train, origin, h), h, **options) for h in horizons}


def predict(features: DataFrame, models: dict[int, PipelineModel]) -> DataFrame:
    """`features` with one predicted column per horizon."""
    df = features
    for h, model in models.items():
        df = model.transform(df).drop("x")
    return df


def score_latest(features: DataFrame, models: dict[int, PipelineModel], as_of: Column,
                 version: str) -> DataFrame:
    """Predictions in canonical form from the last hour of each sector that was over at `as_of`.

    `prediction_ts` is that hour, so "+n h" is n hours after it; `dt` is the day of `as_of`.
    """
    known = features.where(F.col("window_start") <= as_of - F.make_dt_interval(hours=F.lit(1)))
    latest = latest_per_group(known, ["sector_id"], "window_start")
    return predict(latest, models).select(
        "sector_id", F.col("window_start").alias("prediction_ts"), F.lit(version).alias("model_version"),
        *[F.col(f"predicted_arrivals_h{h}") for h in models], F.to_date(as_of).alias("dt"))


def naive_predictions(features: DataFrame) -> DataFrame:
    """A forecast for every hour without a model, in canonical form.

    Made in the last minute of the hour: the next hour like the last four, in 24 hours the
    same as now, and in between their mean with the value of yesterday. Its version is the day.
    """
    made = F.col("window_start") + F.make_dt_interval(mins=F.lit(59))
    rolling, lag = F.col("rolling_avg_arrivals_4h"), F.col("lag_arrivals_24h")
    return features.select(
        "sector_id", made.alias("prediction_ts"),
        F.concat(F.lit("naive-"), version_stamp(F.col("dt"))).alias("model_version"),
        rolling.alias("predicted_arrivals_h1"),
        ((rolling + lag) / 2).alias("predicted_arrivals_h4"),
        F.col("arrivals_count").cast("double").alias("predicted_arrivals_h24"), "dt")


def with_naive(features: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """`features` with `naive_arrivals_h<h>`: the arrivals 24 h before the target hour, by clock."""
    value = """max(arrivals_count) OVER (PARTITION BY sector_id ORDER BY window_start
        RANGE BETWEEN INTERVAL {0} HOURS PRECEDING AND INTERVAL {0} HOURS PRECEDING)"""
    return features.withColumns({f"naive_arrivals_h{h}": F.expr(value.format(24 - h)) for h in horizons})


def _by_horizon(rows: DataFrame, horizons: Sequence[int], *kinds: str) -> DataFrame:
    """One row per hour and horizon with the columns `<kind>_arrivals_h<h>` as `kind`."""
    each = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), *[F.col(f"{k}_arrivals_h{h}").cast("double").alias(k) for k in kinds])
        for h in horizons]))
    kept = [c for c in ("origin", "sector_id", "window_start") if c in rows.columns]
    return rows.select(*kept, each.alias("_h")).select(*kept, "_h.*")


def origins_before(end: dt.datetime, days: int, count: int) -> list[dt.datetime]:
    """`count` cut-offs, oldest first, whose held-out windows of `days` days end one after another at `end`."""
    return [end - dt.timedelta(days=days * i) for i in range(count, 0, -1)]


def of_origin(features: DataFrame, origin: dt.datetime, days: int) -> DataFrame:
    """The hours held out for one origin."""
    at = F.lit(origin).cast("timestamp_ntz")
    return features.where((F.col("window_start") >= at)
                          & (F.col("window_start") < at + F.make_dt_interval(days=F.lit(days)))).withColumn("origin", at)


def held_out_naive(features: DataFrame, origins: Sequence[dt.datetime], days: int,
                   horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """`origin, horizon, pairs, naive_mae`: the bar that a model has to beat in each window.

    Windows of `days` days begin at the origins; hours without a target or without a value 24 h
    before it are left out. Windows may overlap: an hour counts in each of its own.
    """
    start = F.explode(F.filter(
        F.array(*[F.lit(o).cast("timestamp_ntz") for o in origins]),
        lambda o: (F.col("window_start") >= o) & (F.col("window_start") < o + F.make_dt_interval(days=F.lit(days)))))
    rows = with_naive(features, horizons).withColumn("origin", start)
    pairs = _by_horizon(rows, horizons, "target", "naive").dropna(subset=["target", "naive"])
    return pairs.groupBy("origin", "horizon").agg(
        F.count(F.lit(1)).alias("pairs"), F.avg(F.abs(F.col("target") - F.col("naive"))).alias("naive_mae"))


def held_out_error(held: DataFrame, models: dict[int, PipelineModel]) -> DataFrame:
    """Per horizon (and `origin`, if there is such a column) on held-out hours: errors of the model,
    and MAE of 'same as 24 h before the target hour' as the bar.

    Both are of the same pairs, those with a target and a value 24 h before it. Pass hours with
    the columns of `with_naive` made before the split; else the first hours have no bar.
    """
    horizons = list(models)
    if f"naive_arrivals_h{horizons[0]}" not in held.columns:
        held = with_naive(held, horizons)
    pairs = _by_horizon(predict(held, models), horizons, "target", "naive", "predicted")
    miss = F.abs(F.col("target") - F.col("predicted"))
    by = [c for c in ("origin", "horizon") if c in pairs.columns]
    return pairs.dropna(subset=["target", "naive"]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("pairs"), F.avg(miss).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.when(F.col("target") != 0, miss / F.col("target"))).alias("mape"),
        F.avg(F.abs(F.col("target") - F.col("naive"))).alias("naive_mae")).orderBy(*by)


def rolling_errors(features: DataFrame, origins: Sequence[dt.datetime], days: int,
                   horizons: Sequence[int] = HORIZONS, **options) -> tuple[DataFrame, dict[int, PipelineModel]]:
    """Errors by origin and horizon of models fitted anew at each origin, and the newest models.

    Pass stored features: each fit reads them.
    """
    rows, parts, fitted = with_naive(features, horizons), [], {}
    for origin in sorted(origins):
        fitted = fit_horizons(features, horizons, F.lit(origin).cast("timestamp_ntz"), **options)
        parts.append(held_out_error(of_origin(rows, origin, days), fitted))
    return reduce(DataFrame.unionByName, parts), fitted


def over_origins(errors: DataFrame) -> DataFrame:
    """One row per horizon: means over the origins, weighted by their pairs, and the deviation of
    the MAE between them (null for one origin)."""
    def mean(c: str) -> Column:
        return (F.sum(F.col(c) * F.col("pairs")) / F.sum(F.when(F.col(c).isNotNull(), F.col("pairs")))).alias(c)
    return errors.groupBy("horizon").agg(
        F.count(F.lit(1)).cast("int").alias("origins"), F.sum("pairs").alias("pairs"), mean("mae"),
        F.sqrt(F.sum(F.col("rmse") * F.col("rmse") * F.col("pairs")) / F.sum("pairs")).alias("rmse"),
        mean("mape"), mean("naive_mae"), F.stddev_samp("mae").alias("mae_sd"))
