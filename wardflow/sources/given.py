"""The given star-schema tables seen as care-flow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.schemas import SECTORS

# Event type of the given table -> step of an encounter. Fixed values.
STEP_OF = {"view": "triage_start", "click": "triage_end", "purchase": "care_start", "signup": "discharge"}
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# Sector, manager, functional capacity. Fixed values.
SECTOR_ROWS = [
    ("click", "manager A", 6),
    ("error", "manager B", 4),
    ("purchase", "manager C", 5),
    ("signup", "manager D", 3),
    ("view", "manager E", 8),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def encounters(events: DataFrame) -> DataFrame:
    """Each event as the arrival of one encounter; its type is the sector."""
    return events.select(
        F.col("event_id").cast("string").alias("encounter_id"),
        F.col("ts").alias("arrival_time"),
        F.col("user_id").cast("string").alias("patient_id"),
        (F.get_json_object("props", "$.k").cast("int") % 5 + 1).alias("triage_level"),
        F.to_date("ts").alias("dt"),
        F.col("event_type").alias("sector_id"))


def bronze_encounters(events: DataFrame) -> DataFrame:
    """The same as text as it might arrive: times of type 'error' cannot be read, and every
    encounter is delivered again one minute later."""
    as_text = encounters(events).select(
        "encounter_id",
        F.when(F.col("sector_id") == "error", F.concat(F.lit("at "), F.col("arrival_time").cast("string")))
        .otherwise(F.col("arrival_time").cast("string")).alias("arrival_time"),
        "patient_id", F.col("triage_level").cast("string").alias("triage_level"), "dt", "sector_id")
    again = as_text.withColumn(
        "arrival_time",
        (F.col("arrival_time").try_cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(1))).cast("string"))
    return as_text.unionByName(again)


def _encounter_key():
    return F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))


def care_events(events: DataFrame) -> DataFrame:
    """Events as steps of the encounter of their user and day."""
    step = F.create_map(*[F.lit(x) for pair in STEP_OF.items() for x in pair])
    return (events.where(F.col("event_type").isin(*STEP_OF))
            .select(F.col("event_id").cast("string").alias("event_id"),
                    _encounter_key().alias("encounter_id"),
                    step[F.col("event_type")].alias("event_type"),
                    F.col("ts").alias("event_timestamp"),
                    F.to_date("ts").alias("dt")))


def care_encounters(events: DataFrame) -> DataFrame:
    """One encounter per user and day: it arrives with the first event, whose type is its
    sector (the first of EVENT_TYPES at equal times)."""
    firsts = events.groupBy(_encounter_key().alias("encounter_id")).agg(
        F.min("user_id").alias("user_id"),
        *[F.min(F.when(F.col("event_type") == t, F.col("ts"))).alias(f"_{t}") for t in EVENT_TYPES])
    arrival = F.least(*[F.col(f"_{t}") for t in EVENT_TYPES])
    sector = F.coalesce(*[F.when(F.col(f"_{t}") == arrival, t) for t in EVENT_TYPES])
    return firsts.select(
        "encounter_id", arrival.alias("arrival_time"),
        F.col("user_id").cast("string").alias("patient_id"),
        (F.col("user_id") % 5 + 1).cast("int").alias("triage_level"),
        F.to_date(arrival).alias("dt"), sector.alias("sector_id"))


def sectors(spark: SparkSession) -> DataFrame:
    """The sector table as an inline relation: its size is known when a join is planned."""
    rows = ", ".join(f"('{s}', '{m}', {c})" for s, m, c in SECTOR_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(SECTORS.fieldNames())})")


def documents(docs: DataFrame) -> DataFrame:
    """Documents with a citable source, unique per document."""
    return docs.select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source"), "text")
