"""Bronze to silver: typed, one row per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wardflow.operators.dedup import keep_first
from wardflow.operators.timeline import encounter_timeline, encounter_waits
from wardflow.schemas import SILVER_ENCOUNTERS, SILVER_EVENTS, SILVER_WAITS, conform


def _instant(df: DataFrame, name: str) -> Column:
    """Text that is not a time becomes null, for the quality checks to count."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name).cast("timestamp_ntz")


def reject_reason(bronze: DataFrame, key: str, ts: str) -> Column:
    """Why a delivered row cannot be taken: no id, or a time that cannot be read; null if it can."""
    identity = F.col(key).cast("string")
    return (F.when(identity.isNull() | (F.trim(identity) == ""), f"no {key}")
            .when(_instant(bronze, ts).isNull(), f"{ts} not readable"))


def rejects(bronze: DataFrame, table: str, key: str, ts: str) -> DataFrame:
    """Rows of SILVER_REJECTS: every delivery that is not taken, before any is dropped as a repeat."""
    reason = reject_reason(bronze, key, ts)
    return bronze.where(reason.isNotNull()).select(
        F.lit(table).alias("source_table"), reason.alias("reason"),
        F.to_json(F.struct(*[c for c in bronze.columns if c != "dt"])).alias("record"), F.col("dt").cast("date").alias("dt"))


def silver_encounters(bronze: DataFrame) -> DataFrame:
    typed = bronze.withColumns({
        "arrival_time": _instant(bronze, "arrival_time"),
        "triage_level": F.col("triage_level").try_cast("int"),
        "dt": F.col("dt").cast("date")})
    return conform(keep_first(typed, ["encounter_id"], ["arrival_time"]), SILVER_ENCOUNTERS)


def silver_events(bronze: DataFrame) -> DataFrame:
    typed = bronze.withColumns({
        "event_timestamp": _instant(bronze, "event_timestamp"), "dt": F.col("dt").cast("date")})
    return conform(keep_first(typed, ["event_id"], ["event_timestamp"]), SILVER_EVENTS)


def silver_waits(encounters: DataFrame, events: DataFrame) -> DataFrame:
    return conform(encounter_waits(encounter_timeline(encounters, events)), SILVER_WAITS)
