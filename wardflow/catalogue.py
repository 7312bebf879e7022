"""Every operator as a named query over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, StringType, TimestampType

from wardflow.functions.numbers import coerce_number
from wardflow.functions.texts import is_missing
from wardflow.functions.times import hours
from wardflow.functions.vectors import norm
from wardflow.operators import evaluation, features, forecast, load, quality, retrieval, sketches, status
from wardflow.operators.asof import asof_join
from wardflow.operators.classify import SEVERITIES, classify, fit_text_models, validate
from wardflow.operators.dedup import keep_first, latest_per_group
from wardflow.operators.encode import embed
from wardflow.operators.hourly import hourly_metrics_dense, hourly_metrics_sparse
from wardflow.operators.texts import kb_chunks
from wardflow.operators.timeline import (
    DURATIONS, encounter_timeline, encounter_waits, orphan_events, with_sector)
from wardflow.plans import daily
from wardflow.plans.silver import silver_encounters
from wardflow.schemas import GOLD_FEATURES, GOLD_METRICS, GOLD_OPS, KB_STORED, SILVER_ENCOUNTERS, SILVER_REJECTS, SILVER_WAITS, conform
from wardflow.session import run_dir
from wardflow.sources import catalog, given, lake, models
from wardflow.streaming import files
from wardflow.streaming.hourly import hourly_metrics_stream
from wardflow.streaming.ingest import dedup_stream, ingest_stream
from wardflow.streaming.knowledge import chunk_stream, upsert_stream
from wardflow.streaming.score import score_latest_stream, score_stream

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.date(2024, 1, 15)
AS_OF = "2024-01-15 15:30:00"
RANGE = ("2024-01-03 00:00:00", "2024-01-28 12:00:00")
MAX_NULL_RATE = 0.07

_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: days and lists as text, doubles to six places."""
    def column(f):
        c = F.col(f.name)
        if isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            c = F.array_join(c, "|")
        return c.alias(f.name)
    return df.select(*[column(f) for f in df.schema])


def _query(f: Query) -> Query:
    """Registers `f` by its name; a leading q_ only keeps it apart from an imported operator."""
    _QUERIES[f.__name__.removeprefix("q_")] = lambda spark, sf_dir: _portable(f(spark, sf_dir))
    return f


# --- shared inputs ------------------------------------------------------------------------

def _events(spark, d):
    return given.table(spark, d, "events")


def _encounters(spark, d):
    return given.encounters(_events(spark, d))


def _sparse(spark, d):
    return hourly_metrics_sparse(_encounters(spark, d))


def _dense(spark, d):
    return hourly_metrics_dense(_sparse(spark, d))


def _filled(spark, d):
    return features.features_filled(_dense(spark, d))


def _naive(spark, d):
    return forecast.naive_predictions(_filled(spark, d))


def _timeline(spark, d):
    events = _events(spark, d)
    return encounter_timeline(given.care_encounters(events), given.care_events(events))


def _waits(spark, d):
    return encounter_waits(_timeline(spark, d))


def _chunks(spark, d):
    return kb_chunks(given.documents(given.table(spark, d, "documents")))


def _spread_chunks(spark, d):
    return kb_chunks(lake.spread(given.documents(given.table(spark, d, "documents"))))


# --- scans, sinks -------------------------------------------------------------------------

@_query
def scan_partition(spark, d):
    """One day; the filter on the day reaches the scan as a range of times."""
    day = F.lit(DAY).cast("timestamp_ntz")
    events = _events(spark, d).where((F.col("ts") >= day) & (F.col("ts") < day + hours(24)))
    return given.encounters(events)


@_query
def roundtrip_partitioned(spark, d):
    """Silver written by day and sector, written again, and read back."""
    root = run_dir(spark, "roundtrip")
    for _ in range(2):
        lake.overwrite_days(conform(_encounters(spark, d), SILVER_ENCOUNTERS), root, "silver_encounters")
    back = lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS)
    return back.groupBy("dt", "sector_id").agg(
        F.count("*").alias("encounters"), F.min("arrival_time").alias("first_arrival"),
        F.max("arrival_time").alias("last_arrival"), F.sum("triage_level").alias("triage_sum"))


@_query
def append_bronze(spark, d):
    """Bronze of all days added twice: files pile up, nothing is replaced."""
    root = run_dir(spark, "append")
    for _ in range(2):
        lake.append(given.care_events(_events(spark, d)), root, "bronze_events")
    return lake.read_table(spark, root, "bronze_events").groupBy("dt", "event_type").agg(
        F.count("*").alias("deliveries"), F.countDistinct("event_id").alias("event_ids"))


@_query
def append_predictions(spark, d):
    """Predictions of two runs, told apart by their run stamp."""
    root = run_dir(spark, "predictions")
    for minute in (0, 15):
        lake.append_predictions(_naive(spark, d), root, dt.datetime(2024, 2, 1, 6, minute))
    return lake.read_table(spark, root, "gold_predictions").groupBy(
        "dt", F.col("run_ts").cast("string").alias("run_ts")).agg(
        F.count("*").alias("predictions"), F.sum("predicted_arrivals_h24").alias("sum_h24"))


@_query
def export_csv(spark, d):
    """The preview as CSV, read back."""
    path = run_dir(spark, "csv")
    lake.export_csv(status.predictions_preview(_naive(spark, d)), path)
    kinds = ("sector_id string, prediction_ts string, model_version string, predicted_arrivals_h1 "
             "double, predicted_arrivals_h4 double, predicted_arrivals_h24 double, dt string")
    return spark.read.schema(kinds).option("header", True).csv(path)


def _views(spark, d):
    """Gold metrics and predictions behind external tables; returns the database of the views."""
    root, database = run_dir(spark, "tables"), f"wardflow_{uuid.uuid4().hex[:12]}"
    lake.overwrite_days(conform(_sparse(spark, d), GOLD_METRICS), root, "gold_metrics")
    lake.append_predictions(_naive(spark, d), root, dt.datetime(2024, 2, 1, 6))
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    catalog.create_tables(spark, root, database)
    catalog.create_views(spark, database, AS_OF)
    return database


@_query
def external_tables(spark, d):
    return spark.table(f"{_views(spark, d)}.vw_current_status")


@_query
def external_forecast(spark, d):
    return spark.table(f"{_views(spark, d)}.vw_forecast_next_24h")


# --- silver -------------------------------------------------------------------------------

@_query
def q_silver_encounters(spark, d):
    return silver_encounters(given.bronze_encounters(_events(spark, d)))


@_query
def silver_rejects(spark, d):
    """Bronze of one day with ids taken from some rows: what silver does not take, every delivery counted."""
    root = run_dir(spark, "rejects")
    unnamed = F.when((F.col("sector_id") != "signup") | (F.col("triage_level") != "3"), F.col("encounter_id"))
    bronze = given.bronze_encounters(_events(spark, d)).withColumn("encounter_id", unnamed).where(F.col("dt") == F.lit(DAY))
    lake.append(bronze, root, "bronze_encounters")
    daily.bronze_to_silver(spark, root, DAY)
    return lake.read_table(spark, root, "silver_rejects", SILVER_REJECTS).groupBy("dt", "source_table", "reason").agg(
        F.count("*").alias("deliveries"), F.countDistinct("record").alias("records"))


@_query
def coerce_numeric(spark, d):
    """Numbers written as text, some of them unreadable, by sector."""
    text = F.when(F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit(" eur"))) \
        .when(F.col("event_type") == "view", F.concat(F.col("value").cast("string"), F.lit("d"))) \
        .otherwise(F.col("value").cast("string"))
    numbers = _events(spark, d).select(F.col("event_type").alias("sector_id"), coerce_number(text).alias("x"))
    return numbers.groupBy("sector_id").agg(
        F.count("*").alias("texts"), F.count("x").alias("numbers"), F.min("x").alias("smallest"),
        F.max("x").alias("largest"))


@_query
def dedup_encounters(spark, d):
    """Every encounter delivered again one minute later: the earlier one stays."""
    first = _encounters(spark, d)
    again = first.withColumn("arrival_time", F.col("arrival_time") + F.make_dt_interval(mins=F.lit(1)))
    return keep_first(first.unionByName(again), ["encounter_id"], ["arrival_time"])


@_query
def dedup_events(spark, d):
    """Every event delivered three times, twice at the same instant: one stays, settled by
    the remaining columns."""
    e = given.care_events(_events(spark, d))
    later = e.withColumn("event_timestamp", F.col("event_timestamp") + hours(1))
    other = e.withColumn("event_type", F.concat(F.col("event_type"), F.lit("_again")))
    return keep_first(later.unionByName(other).unionByName(e), ["event_id"], ["event_timestamp"])


@_query
def q_encounter_timeline(spark, d):
    return _timeline(spark, d)


@_query
def q_encounter_waits(spark, d):
    return _waits(spark, d).select("encounter_id", "sector_id", "dt", *DURATIONS, "negative_durations")


@_query
def sector_dim_join(spark, d):
    return with_sector(_sparse(spark, d), given.sectors(spark)).select(
        "sector_id", "window_start", "arrivals_count", "manager", "functional_capacity")


@_query
def dq_orphans(spark, d):
    """Steps of encounters that never started triage, counted by day and type."""
    events = given.care_events(_events(spark, d))
    known = events.where(F.col("event_type") == "triage_start").select("encounter_id").distinct()
    return orphan_events(events, known).groupBy("dt", "event_type").agg(F.count("*").alias("orphans"))


# --- gold ---------------------------------------------------------------------------------

@_query
def q_hourly_metrics_sparse(spark, d):
    return _sparse(spark, d)


@_query
def q_hourly_metrics_dense(spark, d):
    return _dense(spark, d)


def _coarse(df, *columns):
    """Means of minutes to four places: engines add doubles in different orders."""
    return df.withColumns({c: F.round(c, 4) for c in columns})


@_query
def wait_avg_hourly(spark, d):
    return _coarse(load.wait_avg_hourly(_waits(spark, d)), "wait_avg_60m")


@_query
def occupancy_hourly(spark, d):
    return load.occupancy_hourly(load.hourly_load(_waits(spark, d)), given.sectors(spark)).select(
        "sector_id", "window_start", "occupied_beds", "functional_capacity", "occupancy_rate")


@_query
def queue_size(spark, d):
    return load.hourly_load(_waits(spark, d)).select("sector_id", "window_start", "queue_size")


@_query
def risk_hourly(spark, d):
    ops = load.ops_metrics_hourly(load.hourly_load(_waits(spark, d)), given.sectors(spark))
    return _coarse(ops, "wait_avg_60m", "risk_score")


LATE_DAYS = [dt.date(2024, 1, n) for n in (5, 12, 13)]


@_query
def load_incremental(spark, d):
    """The load of all days, built while discharges of three of them were missing, then updated
    for these days alone."""
    root, sectors = run_dir(spark, "load"), given.sectors(spark)
    waits = lake.stored(conform(_waits(spark, d), SILVER_WAITS))
    missing = F.when(~F.col("dt").isin(LATE_DAYS), F.col("discharge_time"))
    lake.overwrite_days(waits.withColumn("discharge_time", missing), root, "silver_waits")
    daily.update_load(spark, root, sectors, [r.dt for r in waits.select("dt").distinct().collect()])
    lake.overwrite_days(waits.where(F.col("dt").isin(LATE_DAYS)), root, "silver_waits", LATE_DAYS)
    daily.update_load(spark, root, sectors, LATE_DAYS)
    return _coarse(lake.read_table(spark, root, "gold_ops", GOLD_OPS), "wait_avg_60m", "risk_score")


@_query
def current_status(spark, d):
    """An hour inside the window has all its arrivals inside it, so older events are not read."""
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    recent = _events(spark, d).where(F.col("ts").between(as_of - hours(2), as_of + hours(1)))
    return status.current_status(hourly_metrics_sparse(given.encounters(recent)), as_of)


@_query
def forecast_today(spark, d):
    return status.forecast_today(_naive(spark, d), F.lit(AS_OF).cast("timestamp_ntz"))


# --- features -----------------------------------------------------------------------------

@_query
def rolling_avg_4(spark, d):
    return features.rolling_mean(_sparse(spark, d)).select(
        "sector_id", "window_start", "arrivals_count", "rolling_avg_arrivals_4h")


@_query
def lag_24(spark, d):
    return features.lagged(_sparse(spark, d), rows=(1, 24)).select(
        "sector_id", "window_start", "arrivals_count", "lag_arrivals_1h", "lag_arrivals_24h")


@_query
def rolling_avg_4h_range(spark, d):
    return features.time_true(_sparse(spark, d)).select(
        "sector_id", "window_start", "arrivals_count", "rolling_avg_arrivals_4h", "lag_arrivals_24h")


@_query
def features_strict(spark, d):
    return features.features_strict(_sparse(spark, d))


@_query
def features_strict_dense(spark, d):
    return features.features_strict(_dense(spark, d), features.FEATURES)


@_query
def features_filled(spark, d):
    return _filled(spark, d)


@_query
def features_of_day(spark, d):
    """The daily run: one day, equal to those rows of a run over all history."""
    return daily.features_of_days(conform(_sparse(spark, d), GOLD_METRICS), DAY, DAY)


@_query
def latest_per_sector(spark, d):
    return latest_per_group(_filled(spark, d), ["sector_id"], "window_start").select(
        "sector_id", "window_start", *features.FEATURES)


# --- forecasts ----------------------------------------------------------------------------

@_query
def predictions_long(spark, d):
    return evaluation.predictions_long(_naive(spark, d))


@_query
def predictions_preview(spark, d):
    return status.predictions_preview(_naive(spark, d))


@_query
def pred_vs_actual(spark, d):
    return evaluation.predicted_vs_actual(_naive(spark, d), _dense(spark, d)).select(
        "sector_id", "prediction_ts", "horizon", "target_hour", "predicted_arrivals", "actual_arrivals")


@_query
def pred_asof(spark, d):
    """For every arrival: what was predicted three hours before it."""
    arrivals = _encounters(spark, d).select(
        "encounter_id", "sector_id", (F.col("arrival_time") - hours(3)).alias("asked_at"))
    naive = _naive(spark, d).withColumn("made_at", F.col("prediction_ts"))
    return asof_join(arrivals, naive, "sector_id", "asked_at", "made_at",
                     ["prediction_ts", "predicted_arrivals_h1"], lake.stored)


@_query
def forecast_mape(spark, d):
    return evaluation.forecast_error(
        evaluation.predicted_vs_actual(_naive(spark, d), _dense(spark, d)), ["sector_id", "horizon"])


@_query
def drift_psi(spark, d):
    """The last seven days of features against the days before."""
    f = _filled(spark, d)
    cutoff = F.date_sub(f.agg(F.max("dt")).scalar(), 6)
    return evaluation.drift_psi(f.where(F.col("dt") < cutoff), f.where(F.col("dt") >= cutoff),
                                ["arrivals_count", *features.FEATURES])


@_query
def drift_sketches(spark, d):
    """As drift_psi, from one sketch per day; each figure within 0.02 of the exact one."""
    f = lake.stored(_filled(spark, d))
    columns = ["arrivals_count", *features.FEATURES]
    cutoff = F.date_sub(f.agg(F.max("dt")).scalar(), 6)
    days = lake.stored(sketches.column_sketches(f, columns, ["dt"]))
    past, now = F.col("dt") < cutoff, F.col("dt") >= cutoff
    exact = evaluation.drift_psi(f.where(past), f.where(now), columns).select("feature", F.col("psi").alias("_exact"))
    return sketches.drift_of_sketches(days.where(past), days.where(now)).join(exact, "feature").select(
        "feature", (F.abs(F.col("psi") - F.col("_exact")) <= 0.02).alias("near"), "baseline_rows", "current_rows")


def _stored_features(spark, d):
    """Features computed once and read by every fit."""
    return lake.stored(conform(_filled(spark, d), GOLD_FEATURES))


def _split(f):
    cutoff = F.date_sub(f.agg(F.max("dt")).scalar(), 6).cast("timestamp_ntz")
    return forecast.split_by_time(f, cutoff)


@_query
def gbt_h1(spark, d):
    """Next-hour forecast of the last seven days by trees fitted on the days before."""
    past, held = _split(_stored_features(spark, d))
    return forecast.predict(held, {1: forecast.fit_horizon(past, 1)}).select(
        "sector_id", "window_start", "target_arrivals_h1", "predicted_arrivals_h1")


@_query
def score_latest(spark, d):
    """All horizons for the last hour of every sector."""
    f = _stored_features(spark, d)
    past, _ = _split(f)
    as_of = f.agg(F.max("window_start") + F.make_dt_interval(mins=F.lit(59))).scalar()
    return forecast.score_latest(f, forecast.fit_horizons(past), as_of, "202401300000")


@_query
def held_out_naive(spark, d):
    """The bar for each horizon in the three windows of four days before a moment."""
    return forecast.held_out_naive(_filled(spark, d), forecast.origins_before(dt.datetime(2024, 1, 28), 4, 3), 4)


@_query
def model_registry(spark, d):
    """Models of all horizons trained, stored and registered; the newest version as loaded."""
    root = run_dir(spark, "registry")
    lake.append(conform(_filled(spark, d), GOLD_FEATURES), root, "gold_features")
    daily.train(spark, root, dt.datetime(2024, 1, 30, 12))
    version, fitted = models.load_latest(spark, root)
    return models.registry(spark, root).where(
        (F.col("version") == version) & F.col("horizon").isin(*fitted)).drop("path")


# --- quality ------------------------------------------------------------------------------

@_query
def dq_existence(spark, d):
    """One day more is expected than has come."""
    e = _encounters(spark, d)
    return quality.existence(e, quality.expected_days(e, last=F.date_add(F.max("dt"), 1)))


@_query
def dq_nulls(spark, d):
    return quality.null_counts(_waits(spark, d), ["arrival_time", *DURATIONS], max_rate=0.7)


@_query
def dq_ts_range(spark, d):
    low, high = (F.lit(t).cast("timestamp_ntz") for t in RANGE)
    return quality.timestamp_range(_encounters(spark, d), "arrival_time", low, high)


@_query
def dq_report(spark, d):
    low, high = (F.lit(t).cast("timestamp_ntz") for t in RANGE)
    silver = silver_encounters(given.bronze_encounters(_events(spark, d)))
    days = quality.expected_days(silver, last=F.date_add(F.max("dt"), 1))
    return quality.report(silver, days, ["encounter_id", "arrival_time", "triage_level"],
                          "arrival_time", low, high, MAX_NULL_RATE)


# --- text ---------------------------------------------------------------------------------

@_query
def text_rejects(spark, d):
    """Accepted and rejected texts of all text tables; an error event carries no text."""
    texts = given.table(spark, d, "documents").select(F.lit("documents").alias("origin"), "text") \
        .unionByName(given.table(spark, d, "conversations").select(F.lit("conversations").alias("origin"), "text")) \
        .unionByName(_events(spark, d).select(
            F.lit("events").alias("origin"),
            F.when(F.col("event_type") != "error", F.col("props")).otherwise("").alias("text")))
    return texts.groupBy("origin").agg(
        F.count_if(~is_missing("text")).alias("accepted"), F.count_if(is_missing("text")).alias("rejected"))


@_query
def q_kb_chunks(spark, d):
    return _chunks(spark, d)


@_query
def kb_embed_hashing(spark, d):
    """The vector of every chunk, summed up: words, slots in use, length."""
    return embed(_spread_chunks(spark, d)).select(
        "source", "chunk_no",
        F.aggregate("vector", F.lit(0.0), lambda a, x: a + x).cast("long").alias("words"),
        F.size(F.filter("vector", lambda x: x > 0)).alias("slots"),
        norm("vector").alias("length"))


@_query
def cosine_pairs(spark, d):
    """Every vector against the mean vector of its label."""
    v = given.table(spark, d, "embeddings")
    return retrieval.similarity_to_group(v, "label", "embedding", lake.stored).select(
        "vec_id", "label", "similarity")


@_query
def knn_top3(spark, d):
    """The three vectors of the whole table nearest to the mean of each label."""
    v = given.table(spark, d, "embeddings").withColumn("label", F.col("label").cast("long"))
    return retrieval.top_k_similar(v, retrieval.centroids(v, "label", "embedding"), 3,
                                   corpus_id="vec_id", query_id="label", vector="embedding")


def _hits(spark, d):
    corpus = _spread_chunks(spark, d).withColumn(
        "chunk_id", F.concat_ws("#", "source", F.col("chunk_no").cast("string")))
    asked = embed(given.table(spark, d, "benchmark"))
    return corpus, retrieval.top_k_similar(
        embed(corpus), asked, 3, corpus_id="chunk_id", query_id="item_id")


@_query
def kb_top3(spark, d):
    """The three chunks nearest to each benchmark text."""
    return _hits(spark, d)[1]


@_query
def kb_context(spark, d):
    corpus, hits = _hits(spark, d)
    return retrieval.with_context(lake.stored(hits), corpus, "chunk_id").select("query_id", "context")


@_query
def kb_citations(spark, d):
    corpus, hits = _hits(spark, d)
    return retrieval.with_context(lake.stored(hits), corpus, "chunk_id").select("query_id", "citations")


@_query
def text_classify(spark, d):
    """All documents classified by models fitted on the labelled ones."""
    docs = lake.spread(given.table(spark, d, "documents").select("doc_id", "text", "source"))
    known = docs.join(given.table(spark, d, "labels"), "doc_id")
    model = fit_text_models(known, ["quality", "toxic"], run_dir(spark, "text-model"))
    out = classify(docs, model, "quality", "toxic", ("Poor report", "Usable report"), F.col("source"))
    return out.select("doc_id", "classification.*")


def _records(spark, d):
    """Classification records made from events, some of them against the rules."""
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*[F.lit(s) for s in (*SEVERITIES, "Severe")])
    return validate(_events(spark, d).select(
        F.when(k != 13, F.col("event_type")).alias("category"),
        F.element_at(names, k % 5 + 1).alias("severity"),
        F.lit(None).cast("string").alias("root_cause"),
        F.col("event_type").alias("impacted_sector"),
        F.when(k != 7, F.lit("review")).alias("suggested_action"),
        (F.col("value") / 20).alias("confidence"), F.to_date("ts").alias("dt")))


@_query
def classify_validate(spark, d):
    return _records(spark, d).groupBy(
        F.coalesce("problem", F.lit("none")).alias("problem"), "severity").agg(F.count("*").alias("records"))


@_query
def append_classifications(spark, d):
    """Valid records of a run added to their table, the run repeated, and read back."""
    root = run_dir(spark, "classifications")
    valid = _records(spark, d).where(F.col("problem").isNull()).drop("problem")
    for _ in range(2):
        lake.replace_run(valid, root, "gold_classifications", "202402010600")
    return lake.read_table(spark, root, "gold_classifications").groupBy("dt", "severity").agg(
        F.count("*").alias("records"), F.max("confidence").alias("top_confidence"))


# --- streams ------------------------------------------------------------------------------

def _stream(spark, d, name):
    """A given table as a stream of files. As a pattern its path may be one file or a folder."""
    return files.read_files(spark, f"{d}/{{{name}}}.parquet", given.table(spark, d, name).schema)


def _streamed(spark, stream, label):
    """The rows a stream has written when its input is used up."""
    out = run_dir(spark, label)
    files.write_files(stream, f"{out}/data", f"{out}/checkpoint")
    return files.written(spark, stream, f"{out}/data")


@_query
def stream_dedup(spark, d):
    """Every event delivered twice to a stream comes out once."""
    def deliveries():
        return given.care_events(_stream(spark, d, "events")).withColumn(
            "event_timestamp", files.instant("event_timestamp"))
    once = dedup_stream(deliveries().union(deliveries()), "event_id", "event_timestamp")
    return _streamed(spark, once, "stream-dedup")


@_query
def ingest_ledger(spark, d):
    """Events delivered as files by week, one of them again under another name; streamed to bronze,
    and once more from the start without the checkpoint."""
    path, root = run_dir(spark, "deliveries"), run_dir(spark, "ingest")
    given_events = given.care_events(_events(spark, d)).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    parts = lake.stored(given_events.drop("dt").withColumn("week", F.floor(F.dayofmonth(F.to_date("event_timestamp")) / 7)))
    for name, week in enumerate((0, 2, 1, 3, 4, 2)):
        parts.where(F.col("week") == week).drop("week").coalesce(1).write.parquet(f"{path}/delivery={name}")
    for attempt in range(2):
        ingest_stream(spark, f"{path}/delivery=*", root, "events", f"{root}/_checkpoint{attempt}", files_per_batch=2)
    return lake.read_table(spark, root, "bronze_events").groupBy("dt").agg(
        F.count("*").alias("row_count"), F.countDistinct("event_id").alias("event_ids"))


@_query
def stream_hourly(spark, d):
    """Hours closed by the watermark, as the stream emits them."""
    arrivals = given.encounters(_stream(spark, d, "events")).withColumn(
        "arrival_time", files.instant("arrival_time"))
    return _streamed(spark, hourly_metrics_stream(arrivals), "stream-hourly")


@_query
def stream_score(spark, d):
    """Feature rows written to files, then scored for all horizons as a stream."""
    out, path = run_dir(spark, "stream-score"), run_dir(spark, "stream-score-input")
    conform(_filled(spark, d), GOLD_FEATURES).write.parquet(path)
    past, _ = _split(spark.read.schema(GOLD_FEATURES).parquet(path))
    rows = files.read_files(spark, path, GOLD_FEATURES)
    score_stream(rows, forecast.fit_horizons(past), "202401300000",
                 f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


@_query
def kb_replaced_document(spark, d):
    """Versions of all documents streamed to the knowledge base: every third one is replaced by a
    shorter text, every seventh deleted, and an older version of each comes last."""
    docs = given.documents(given.table(spark, d, "documents")).withColumn("n", F.substring_index("source", "/", -1).cast("long"))
    first = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    path, out = run_dir(spark, "kb-versions"), run_dir(spark, "kb")
    steps = [(2, docs, F.col("text"), False),
             (3, docs.where("n % 3 = 0"), F.substring("text", 1, 1500), False),
             (4, docs.where("n % 7 = 0"), F.lit(None).cast("string"), True),
             (1, docs, F.lit("an older version"), False)]
    for i, (hour, rows, text, deleted) in enumerate(steps):
        versions = rows.select("source", (first + hours(hour)).alias("modified"), text.alias("text"), F.lit(deleted).alias("deleted"))
        versions.write.mode("append").parquet(f"{path}/step={i}")
        stream = files.read_files(spark, f"{path}/step=*", versions.schema)
        upsert_stream(stream, out, f"{out}/_checkpoint", buckets=8)
    return lake.read_table(spark, out, "kb_chunks", KB_STORED).select("source", "chunk_no", "text")


@_query
def stream_score_latest(spark, d):
    """Feature rows arriving as files, the newest ones first; predictions of the newest hour of each
    sector as the last run left them."""
    out, path = run_dir(spark, "score-latest"), run_dir(spark, "score-latest-input")
    rows = lake.stored(conform(_filled(spark, d), GOLD_FEATURES))
    fitted = forecast.fit_horizons(_split(rows)[0], max_iter=2)
    for i, part in enumerate((F.col("dt") > F.lit(DAY), F.col("dt") <= F.lit(DAY))):
        rows.where(part).write.parquet(f"{path}/part={i}")
        stream = files.read_files(spark, f"{path}/part=*", GOLD_FEATURES)
        score_latest_stream(stream, fitted, "202401300000", out, f"{out}/_checkpoint")
    found = lake.read_table(spark, out, "gold_predictions")
    known = [F.col(f"predicted_arrivals_h{h}").isNotNull() for h in features.HORIZONS]
    return found.groupBy("sector_id", "prediction_ts", "model_version", "dt").agg(
        F.count("*").alias("runs"), F.bool_and(known[0] & known[1] & known[2]).alias("scored"))


@_query
def stream_kb_chunks(spark, d):
    return _streamed(spark, chunk_stream(given.documents(_stream(spark, d, "documents"))), "stream-kb")
