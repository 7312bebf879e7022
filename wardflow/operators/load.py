"""Queue, beds, waits and risk by sector and hour.

Each encounter becomes at most four dated changes (arrives, leaves the queue, takes a bed,
frees it), which are summed per sector and hour before anything else. A stay of any length
costs two changes, not one row per hour, and a running sum over the hours gives the level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.numbers import risk_score
from wardflow.functions.times import hour_ceil, hour_start, hours
from wardflow.operators.hourly import fill_hours
from wardflow.operators.timeline import with_sector

_COUNTS = ("arrivals_count", "queue_change", "bed_change")


def end_of_arrival_day() -> Column:
    """Midnight after the arrival: where an open stay or wait ends in closed history."""
    return F.date_add(F.to_date("arrival_time"), 1).cast("timestamp_ntz")


def _changes(waits: DataFrame, open_until: Column | None) -> DataFrame:
    """Without `open_until` a stay or wait that has no end makes no change that ends it."""
    arrival, care = F.col("arrival_time"), F.col("care_start")
    care = F.when(care >= arrival, care)
    leaves_queue, leaves_bed = care, F.when(F.col("discharge_time") >= care, F.col("discharge_time"))
    if open_until is not None:
        until = F.greatest(open_until, arrival)
        leaves_queue = F.coalesce(care, until)
        leaves_bed = F.when(care.isNotNull(), F.coalesce(leaves_bed, F.greatest(until, care)))

    def change(when: Column, arrivals: int = 0, queue: int = 0, beds: int = 0,
               wait: Column | None = None) -> Column:
        return F.struct(
            when.alias("window_start"),
            F.lit(arrivals).cast("long").alias("arrivals_count"),
            F.lit(queue).cast("long").alias("queue_change"),
            F.lit(beds).cast("long").alias("bed_change"),
            (wait if wait is not None else F.lit(None).cast("double")).alias("wait_min"))

    per_encounter = F.array(
        change(hour_start(arrival), arrivals=1, queue=1, wait=F.col("wait_service_min")),
        change(hour_start(leaves_queue), queue=-1),
        change(hour_start(care), beds=1),
        change(hour_ceil(leaves_bed), beds=-1),
    )
    kept = [c for c in ("sector_id", "arrival_dt") if c in waits.columns]
    return (waits.where(arrival.isNotNull())
            .select(*kept, F.inline(per_encounter))
            .where(F.col("window_start").isNotNull()))


def hourly_load(waits: DataFrame, open_until: Column | None = None) -> DataFrame:
    """Dense hours per sector: arrivals, mean service wait of those who arrived, people still
    waiting at the end of the hour, and beds in use at some time in the hour.

    A bed is in use in hour h if care started before h + 1 h and the stay ended after h.
    """
    changes = _changes(waits, end_of_arrival_day() if open_until is None else open_until)
    hourly = changes.groupBy("sector_id", "window_start").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.avg("wait_min").alias("wait_avg_60m"))
    so_far = (Window.partitionBy("sector_id").orderBy("window_start")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return fill_hours(hourly, zero=_COUNTS).select(
        "sector_id", "window_start", "arrivals_count", "wait_avg_60m",
        F.sum("queue_change").over(so_far).alias("queue_size"),
        F.sum("bed_change").over(so_far).alias("occupied_beds"))


def daily_changes(waits: DataFrame) -> DataFrame:
    """What the stored waits of some days (`dt`, the arrival day) change, in any hour: one row per
    sector, hour and arrival day. Waits are summed in whole microseconds, so that the order of
    adding does not matter. `dt` is the day the change takes effect."""
    per_hour = _changes(waits.withColumnRenamed("dt", "arrival_dt"), None).groupBy(
        "sector_id", "window_start", "arrival_dt").agg(
        *[F.sum(c).alias(c) for c in _COUNTS],
        F.sum(F.round(F.col("wait_min") * 60e6).cast("long")).alias("wait_us"), F.count("wait_min").alias("wait_count"))
    return per_hour.withColumn("dt", F.to_date("window_start"))


def levels_from(opening: DataFrame, changes: DataFrame, start: Column, until: Column) -> DataFrame:
    """The columns of `hourly_load` for every hour up to `until`, exclusive, by running sums over an
    `opening(sector_id, queue_size, occupied_beds)` at `start` and the changes from there on. A
    sector without an opening begins with its first change."""
    none = F.lit(0).cast("long")
    opened = opening.select(
        "sector_id", start.alias("window_start"), none.alias("arrivals_count"),
        F.col("queue_size").alias("queue_change"), F.col("occupied_beds").alias("bed_change"),
        F.lit(None).cast("long").alias("wait_us"), none.alias("wait_count"))
    in_range = changes.where(F.col("window_start") < until).select(*opened.columns)
    hourly = opened.unionByName(in_range).groupBy("sector_id", "window_start").agg(
        *[F.sum(c).alias(c) for c in (*_COUNTS, "wait_us", "wait_count")])
    # The last hour of the range, for each sector seen so far.
    closing = hourly.groupBy("sector_id").agg(F.max("window_start").alias("_last")).where(
        F.col("_last") < until - hours(1)).select(
        "sector_id", (until - hours(1)).alias("window_start"), *[none.alias(c) for c in _COUNTS],
        F.lit(None).cast("long").alias("wait_us"), none.alias("wait_count"))
    so_far = (Window.partitionBy("sector_id").orderBy("window_start")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return fill_hours(hourly.unionByName(closing), zero=_COUNTS).select(
        "sector_id", "window_start", "arrivals_count",
        (F.col("wait_us") / F.when(F.col("wait_count") > 0, F.col("wait_count")) / F.lit(60e6)).alias("wait_avg_60m"),
        F.sum("queue_change").over(so_far).alias("queue_size"),
        F.sum("bed_change").over(so_far).alias("occupied_beds"))


def wait_avg_hourly(waits: DataFrame) -> DataFrame:
    """Mean service wait by sector and hour of arrival; hours without a known wait are absent."""
    return (
        waits.where(F.col("wait_service_min").isNotNull())
        .groupBy("sector_id", F.window("arrival_time", "1 hour").alias("w"))
        .agg(F.avg("wait_service_min").alias("wait_avg_60m"),
             F.count("*").alias("waits_count"))
        .select("sector_id", F.col("w.start").alias("window_start"), "wait_avg_60m", "waits_count"))


def occupancy_hourly(load: DataFrame, sectors: DataFrame) -> DataFrame:
    """Beds in use over functional capacity; null where the capacity is unknown or 0."""
    capacity = F.col("functional_capacity")
    return with_sector(load, sectors).withColumn(
        "occupancy_rate", F.when(capacity > 0, F.col("occupied_beds") / capacity))


def ops_metrics_hourly(load: DataFrame, sectors: DataFrame) -> DataFrame:
    """The full hourly operations table: arrivals, wait, queue, occupancy and risk."""
    return occupancy_hourly(load, sectors).select(
        "window_start", F.hour("window_start").alias("hour"), "arrivals_count", "wait_avg_60m",
        "queue_size", "occupied_beds", "occupancy_rate",
        risk_score(F.col("occupancy_rate"), F.col("wait_avg_60m")).alias("risk_score"),
        F.to_date("window_start").alias("dt"), "sector_id")
