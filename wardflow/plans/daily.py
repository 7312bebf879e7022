"""The daily and scoring jobs over a lake root.

Each step reads the layer below, is one lazy plan, and replaces only the partitions of its
own day, so any step can be run again after a failure.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import forecast, quality
from wardflow.operators.features import FEATURES, HORIZONS, features_filled, features_strict
from wardflow.operators.hourly import hourly_metrics_sparse, hours_of_days
from wardflow.operators.load import daily_changes, hourly_load, levels_from, ops_metrics_hourly
from wardflow.operators.sketches import column_sketches, drift_of_sketches
from wardflow.plans.silver import reject_reason, rejects, silver_encounters, silver_events, silver_waits
from wardflow.schemas import (
    GOLD_FEATURES, GOLD_METRICS, GOLD_OPS, LOAD_BALANCES, LOAD_CHANGES, PREDICTIONS, SILVER_ENCOUNTERS, SILVER_EVENTS,
    SILVER_REJECTS, SILVER_WAITS, SKETCHES, conform)
from wardflow.sources import lake, models

DAY = dt.timedelta(days=1)


# Table -> id, time, and how its rows are made.
_SILVER = {"encounters": ("encounter_id", "arrival_time", silver_encounters),
           "events": ("event_id", "event_timestamp", silver_events)}


def bronze_to_silver(spark: SparkSession, root: str, day: dt.date) -> None:
    refused = []
    for table, (key, ts, build) in _SILVER.items():
        try:
            bronze = lake.read_day(spark, root, f"bronze_{table}", day)
        except lake.EmptyInput:
            if table == "encounters":
                raise
            continue
        taken = bronze.where(reject_reason(bronze, key, ts).isNull())
        lake.overwrite_days(build(taken), root, f"silver_{table}", [day])
        refused.append(rejects(bronze, f"bronze_{table}", key, ts))
    lake.overwrite_days(conform(reduce(DataFrame.unionAll, refused), SILVER_REJECTS), root, "silver_rejects", [day])


def _refused_encounters(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """Deliveries of encounters that silver did not take, as rows that lack what they were refused for."""
    refused = lake.table_or_empty(spark, root, "silver_rejects", SILVER_REJECTS, day, day).where(
        F.col("source_table") == "bronze_encounters")
    told = F.from_json("record", "encounter_id string, arrival_time string, patient_id string, triage_level string, sector_id string")
    return conform(refused.select("dt", told.alias("r")).select(
        F.nullif("r.encounter_id", F.lit("")).alias("encounter_id"),
        F.col("r.arrival_time").try_cast("timestamp_ntz").alias("arrival_time"), F.col("r.patient_id").alias("patient_id"),
        F.col("r.triage_level").try_cast("int").alias("triage_level"), "dt", F.col("r.sector_id").alias("sector_id")),
        SILVER_ENCOUNTERS)


def check_silver(spark: SparkSession, root: str, day: dt.date, max_null_rate: float = 0.0) -> DataFrame:
    """Stores the quality report of the day, then raises if a rule was broken. Deliveries without an
    id or a readable time count as they came, not as the one row that dedup would leave of them.

    Runs before gold is built, so bad days do not spread. Arrivals must fall on the day.
    """
    encounters = lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS, day, day).unionByName(
        _refused_encounters(spark, root, day))
    low = F.lit(day).cast("timestamp_ntz")
    report = quality.report(
        encounters, spark.range(1).select(F.lit(day).alias("dt")),
        ["encounter_id", "arrival_time", "triage_level"], "arrival_time",
        low, low + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND"), max_null_rate)
    lake.write_report(report, root)
    written = lake.read_reports(spark, root, day, day)
    quality.require_passed(written)
    return written


def build_waits(spark: SparkSession, root: str, day: dt.date) -> None:
    """Waits of the day's encounters; their events may be filed under any later day."""
    encounters = lake.read_day(spark, root, "silver_encounters", day, SILVER_ENCOUNTERS)
    events = lake.read_table(spark, root, "silver_events", SILVER_EVENTS, day)
    lake.overwrite_days(silver_waits(encounters, events), root, "silver_waits", [day])


def days_with_news(spark: SparkSession, root: str, day: dt.date) -> list[dt.date]:
    """Earlier days whose encounters have events filed under `day`."""
    events = lake.read_table(spark, root, "silver_events", SILVER_EVENTS, day, day)
    before = lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS, last=day - DAY)
    touched = before.join(events.select("encounter_id"), "encounter_id", "left_semi").select("dt").distinct()
    return sorted(r.dt for r in touched.collect())


def silver_to_gold(spark: SparkSession, root: str, day: dt.date) -> None:
    encounters = lake.read_day(spark, root, "silver_encounters", day, SILVER_ENCOUNTERS)
    # The partition is the day being run, so a stray arrival cannot replace another day.
    metrics = hourly_metrics_sparse(encounters).withColumn("dt", F.lit(day))
    lake.overwrite_days(conform(metrics, GOLD_METRICS), root, "gold_metrics", [day])


def build_load(spark: SparkSession, root: str, sectors: DataFrame, first: dt.date, last: dt.date) -> None:
    """Queue, occupancy and risk of a range of days.

    Levels depend on earlier stays: all that had not ended before the range are read, however
    old. A stay or wait without an end goes on to the end of the range. Hours outside the range
    are not written.
    """
    waits = lake.read_table(spark, root, "silver_waits", SILVER_WAITS, last=last)
    start = F.lit(first).cast("timestamp_ntz")
    there = waits.where((F.col("dt") >= F.lit(first)) | F.col("discharge_time").isNull() | (F.col("discharge_time") >= start))
    end = F.lit(last + DAY).cast("timestamp_ntz")
    ops = ops_metrics_hourly(hourly_load(there, end), sectors)
    days = [first + i * DAY for i in range((last - first).days + 1)]
    lake.overwrite_days(
        conform(ops, GOLD_OPS).where(F.col("dt").between(F.lit(first), F.lit(last))), root, "gold_ops", days)


def update_load(spark: SparkSession, root: str, sectors: DataFrame, changed: Iterable[dt.date],
                last: dt.date | None = None) -> list[dt.date]:
    """Queue, occupancy and risk after the waits of the `changed` arrival days were written anew.

    A change reaches every later day, as people stay. So all days from the first one touched up to
    `last`, or the last one built before if that is later, are rebuilt and returned; from the stored levels at
    its start and the hourly changes since, not from the waits of other days. Days before are neither
    read nor written. Stays and waits without an end go on. A run that failed can be repeated: the
    stored changes of the `changed` days are replaced, and the levels it starts from are not its own.
    """
    changed = sorted(set(changed))
    waits = lake.read_table(spark, root, "silver_waits", SILVER_WAITS).where(F.col("dt").isin(changed))
    new = lake.stored(conform(daily_changes(waits), LOAD_CHANGES))
    balances = lake.table_or_empty(spark, root, "load_balances", LOAD_BALANCES)
    built = balances.agg(F.max("dt")).first()[0]
    first = min(filter(None, [changed[0], new.agg(F.min("dt")).first()[0]]))
    last = max(filter(None, [last, changed[-1], built and built - DAY]))
    base = balances.where(F.col("dt") <= F.lit(first)).agg(F.max("dt")).first()[0]
    old = lake.table_or_empty(spark, root, "load_changes", LOAD_CHANGES, base)
    first = base or min(filter(None, [first, old.agg(F.min("dt")).first()[0]]))

    kept = old.where(~F.col("arrival_dt").isin(changed))
    changes = lake.stored(kept.unionByName(new))
    # One row per stored day.
    touched = {r.dt for r in old.select("dt").distinct().collect()} | {r.dt for r in new.select("dt").distinct().collect()}
    opening = balances.where(F.col("dt") == F.lit(first)) if base else balances.where(F.lit(False))
    end = F.lit(last + DAY).cast("timestamp_ntz")
    levels = levels_from(opening, changes, F.lit(first).cast("timestamp_ntz"), end)
    ops = lake.stored(conform(ops_metrics_hourly(levels, sectors), GOLD_OPS))
    days = [first + i * DAY for i in range((last - first).days + 1)]
    closing = ops.where(F.col("hour") == 23).select(
        "queue_size", "occupied_beds", F.date_add("dt", 1).alias("dt"), "sector_id")
    lake.overwrite_days(ops, root, "gold_ops", days)
    lake.overwrite_days(conform(closing, LOAD_BALANCES), root, "load_balances", [d + DAY for d in days])
    lake.overwrite_days(changes, root, "load_changes", touched)
    return days


def features_of_days(metrics: DataFrame, first: dt.date, last: dt.date, strict: bool = False) -> DataFrame:
    """Features of a range of days, equal to those rows of a run over all history.

    Reads one day more on either side: lags look 24 h back, targets 24 h ahead.
    """
    near = hours_of_days(metrics, F.lit(first), F.lit(last), 24, 24)
    built = features_strict(near, FEATURES) if strict else features_filled(near)
    return conform(built, GOLD_FEATURES).where(F.col("dt").between(F.lit(first), F.lit(last)))


def days_of_features(metrics: DataFrame, day: dt.date) -> tuple[dt.date, dt.date]:
    """The first and last day whose features depend on the arrivals of `day`.

    Targets look 24 h ahead and lags 24 h back, so the days beside it do. A sector that had
    no arrivals for longer has its empty hours filled back to the last one and on to the next one.
    """
    seen = metrics.groupBy("sector_id").agg(
        F.max(F.when(F.col("dt") < F.lit(day), F.col("dt"))).alias("before"),
        F.min(F.when(F.col("dt") > F.lit(day), F.col("dt"))).alias("after"),
        F.max("dt").alias("end")).agg(F.min("before"), F.max("after"), F.max("end")).first()
    before, after, end = seen
    # The empty hours filled after it are in turn targets of the last arrival's day and of the day before.
    first = min(day, before or day) - DAY
    return first, max(day, min(max(day + DAY, after or day), end or day))


def build_features(spark: SparkSession, root: str, day: dt.date) -> None:
    """Features of the day and of all days around it that depend on its arrivals."""
    metrics = lake.read_table(spark, root, "gold_metrics", GOLD_METRICS)
    first, last = days_of_features(metrics, day)
    built = features_of_days(metrics, first, last)
    days = [first + i * DAY for i in range((last - first).days + 1)]
    lake.overwrite_days(built, root, "gold_features", days)
    sketch_days(spark, root, days)


SKETCHED = ("arrivals_count", *FEATURES)


def sketch_days(spark: SparkSession, root: str, days: list[dt.date]) -> None:
    """Sketches of the features and predictions of whole days, in place of those stored before."""
    def of(table, schema):
        return lake.table_or_empty(spark, root, table, schema, min(days), max(days)).where(F.col("dt").isin(days))
    of_features = column_sketches(of("gold_features", GOLD_FEATURES), SKETCHED, ["dt"])
    predicted = [f"predicted_arrivals_h{h}" for h in HORIZONS]
    of_predictions = column_sketches(of("gold_predictions", PREDICTIONS), predicted, ["dt", "model_version"])
    both = of_features.withColumn("model_version", F.lit(None).cast("string")).unionByName(of_predictions)
    lake.overwrite_days(conform(both, SKETCHES), root, "gold_sketches", days)


def drift(spark: SparkSession, root: str, first: dt.date, last: dt.date, before: dt.date | None = None) -> DataFrame:
    """Drift of features and predictions, of all model versions, in the days `first` to `last` against
    all days before `first` (or from `before` on). Reads sketches of days only, no rows."""
    known = lake.require_rows(lake.read_table(spark, root, "gold_sketches", SKETCHES, before, last), "gold_sketches")
    return drift_of_sketches(known.where(F.col("dt") < F.lit(first)), known.where(F.col("dt") >= F.lit(first)))


def train(spark: SparkSession, root: str, as_of: dt.datetime, held_out_days: int = 7, origins: int = 1,
          **options) -> str:
    """Fits one model per horizon on what was known before the held-out days; returns the version.

    With more `origins`, models are also fitted and measured at cut-offs further back, and the
    registry tells how much the error differs between them. The newest cut-off's models are kept.
    """
    until = F.lit(as_of).cast("timestamp_ntz")
    features = lake.require_rows(
        lake.read_table(spark, root, "gold_features", GOLD_FEATURES), "gold_features")
    features = lake.stored(features.where(F.col("window_start") <= until))
    # Cut-offs are full hours; the hour of `as_of` itself belongs to the newest window.
    end = as_of.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    cutoffs = forecast.origins_before(end, held_out_days, origins)
    past = features.where(F.col("window_start") < F.lit(cutoffs[-1]).cast("timestamp_ntz"))
    lake.require_rows(forecast.known_before(features, F.lit(cutoffs[0]).cast("timestamp_ntz"), max(HORIZONS)), "training features")
    errors, fitted = forecast.rolling_errors(features, cutoffs, held_out_days, **options)
    version = as_of.strftime("%Y%m%d%H%M")
    models.save_models(spark, root, version, fitted, forecast.over_origins(errors), past.count())
    return version


def score(spark: SparkSession, root: str, as_of: dt.datetime) -> None:
    """Predictions from the newest model for the last closed hour of each sector, however old."""
    version, fitted = models.load_latest(spark, root)
    features = lake.read_table(spark, root, "gold_features", GOLD_FEATURES, last=as_of.date())
    lake.require_rows(features, "gold_features")
    scored = forecast.score_latest(features, fitted, F.lit(as_of).cast("timestamp_ntz"), version)
    lake.append_predictions(conform(scored, PREDICTIONS), root, as_of)
    sketch_days(spark, root, [as_of.date()])


def run_day(spark: SparkSession, root: str, day: dt.date, sectors: DataFrame | None = None) -> None:
    """Everything for one day up to features, stopping where the quality gate fails."""
    bronze_to_silver(spark, root, day)
    check_silver(spark, root, day)
    news = days_with_news(spark, root, day)
    for each in [*news, day]:
        build_waits(spark, root, each)
    silver_to_gold(spark, root, day)
    if sectors is not None:
        update_load(spark, root, sectors, [*news, day])
    build_features(spark, root, day)
