"""One row per encounter from its events, with waits and length of stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.times import minutes_between, non_negative

# Event type -> timeline column. Fixed values.
STEPS = {
    "triage_start": "triage_start",
    "triage_end": "triage_end",
    "care_start": "care_start",
    "discharge": "discharge_time",
}
DURATIONS = ("wait_triage_min", "wait_service_min", "total_wait_min", "los_min")


def event_times(events: DataFrame) -> DataFrame:
    """The first time of each step per encounter.

    Conditional minima instead of pivot(): one hash aggregate whose map side shrinks an
    encounter with very many events to one row per task, and one shuffle instead of two.
    """
    return events.groupBy("encounter_id").agg(*[
        F.min(F.when(F.col("event_type") == step, F.col("event_timestamp"))).alias(column)
        for step, column in STEPS.items()
    ])


def encounter_timeline(encounters: DataFrame, events: DataFrame) -> DataFrame:
    """Every encounter with the times of its steps.

    Joined on the encounter alone: an event after midnight still belongs to the encounter of
    the day before.
    """
    return encounters.join(event_times(events), "encounter_id", "left")


def encounter_waits(timeline: DataFrame) -> DataFrame:
    """Waits and stay in minutes; null where a step is missing or the clock ran backwards.

    `negative_durations` counts the latter, for the quality checks.
    """
    arrival = F.col("arrival_time")
    raw = {
        "wait_triage_min": minutes_between(arrival, F.col("triage_start")),
        "wait_service_min": minutes_between(
            F.coalesce(F.col("triage_end"), arrival), F.col("care_start")),
        "total_wait_min": minutes_between(arrival, F.col("care_start")),
        "los_min": minutes_between(arrival, F.col("discharge_time")),
    }
    negatives = sum((F.coalesce((c < 0).cast("int"), F.lit(0)) for c in raw.values()), F.lit(0))
    return timeline.withColumns(
        {"negative_durations": negatives, **{n: non_negative(c) for n, c in raw.items()}})


def orphan_events(events: DataFrame, encounters: DataFrame) -> DataFrame:
    """Events whose encounter is unknown."""
    return events.join(encounters.select("encounter_id"), "encounter_id", "left_anti")


def with_sector(facts: DataFrame, sectors: DataFrame) -> DataFrame:
    """Facts with the columns of their sector, or null where the sector is not listed.

    No broadcast hint: Spark broadcasts the sector table while it is under
    spark.sql.autoBroadcastJoinThreshold and otherwise sorts, splitting skewed sectors.
    """
    return facts.join(sectors, "sector_id", "left")
