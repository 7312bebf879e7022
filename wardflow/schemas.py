"""Declared schemas of every stored table, and the check made when one is read.

Times are UTC wall-clock instants without a zone (TIMESTAMP_NTZ), so no result depends on
the session time zone. `sector_id` and `dt` are partition columns where a table is
partitioned by them and therefore come last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType, BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _schema(**columns: DataType) -> StructType:
    out = StructType()
    for name, kind in columns.items():
        out = out.add(name, kind)
    return out


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()
_T, _DAY = TimestampNTZType(), DateType()

# Bronze holds what arrived, as text: nothing is lost to a failed cast.
BRONZE_ENCOUNTERS = _schema(
    encounter_id=_S, arrival_time=_S, patient_id=_S, sector_id=_S, triage_level=_S, dt=_DAY)
BRONZE_EVENTS = _schema(
    event_id=_S, encounter_id=_S, event_type=_S, event_timestamp=_S, dt=_DAY)

# One row per delivered file and run: what it held, and whether it was new.
INGEST_LEDGER = _schema(
    source_table=_S, file=_S, content=_S, row_count=_L, late_rows=_L, last_day=_DAY, status=_S)

SILVER_ENCOUNTERS = _schema(
    encounter_id=_S, arrival_time=_T, patient_id=_S, triage_level=_I, dt=_DAY, sector_id=_S)
SILVER_EVENTS = _schema(
    event_id=_S, encounter_id=_S, event_type=_S, event_timestamp=_T, dt=_DAY)
# Delivered rows that silver does not take, as they came.
SILVER_REJECTS = _schema(source_table=_S, reason=_S, record=_S, dt=_DAY)
SILVER_WAITS = _schema(
    encounter_id=_S, arrival_time=_T, patient_id=_S, triage_level=_I,
    triage_start=_T, triage_end=_T, care_start=_T, discharge_time=_T,
    wait_triage_min=_D, wait_service_min=_D, total_wait_min=_D, los_min=_D,
    negative_durations=_I, dt=_DAY, sector_id=_S)

GOLD_METRICS = _schema(
    window_start=_T, arrivals_count=_L, avg_triage_acuity=_D, dt=_DAY, sector_id=_S)
GOLD_OPS = _schema(
    window_start=_T, hour=_I, arrivals_count=_L, wait_avg_60m=_D, queue_size=_L,
    occupied_beds=_L, occupancy_rate=_D, risk_score=_D, dt=_DAY, sector_id=_S)
# What the encounters of `arrival_dt` change in an hour of `dt`, and the levels at the start of `dt`.
LOAD_CHANGES = _schema(
    window_start=_T, arrivals_count=_L, queue_change=_L, bed_change=_L, wait_us=_L, wait_count=_L,
    arrival_dt=_DAY, dt=_DAY, sector_id=_S)
LOAD_BALANCES = _schema(queue_size=_L, occupied_beds=_L, dt=_DAY, sector_id=_S)
GOLD_FEATURES = _schema(
    window_start=_T, arrivals_count=_L, avg_triage_acuity=_D,
    rolling_avg_arrivals_4h=_D, lag_arrivals_24h=_L,
    target_arrivals_h1=_L, target_arrivals_h4=_L, target_arrivals_h24=_L,
    dt=_DAY, sector_id=_S)
PREDICTIONS = _schema(
    sector_id=_S, prediction_ts=_T, model_version=_S,
    predicted_arrivals_h1=_D, predicted_arrivals_h4=_D, predicted_arrivals_h24=_D, dt=_DAY)

#: `model_version` is null for columns of the features.
SKETCHES = _schema(
    feature=_S, model_version=_S, row_count=_L, lowest=_D, highest=_D, sketch=BinaryType(), dt=_DAY)

SECTORS = _schema(sector_id=_S, manager=_S, functional_capacity=_I)
KB_CHUNKS = _schema(source=_S, chunk_no=_I, text=_S)
KB_VECTORS = _schema(source=_S, chunk_no=_I, text=_S, vector=ArrayType(FloatType()))
# Chunks of the newest version of each source, and which version that is. Sources are dealt to buckets.
KB_STORED = _schema(source=_S, chunk_no=_I, text=_S, vector=ArrayType(FloatType()), bucket=_I)
KB_SOURCES = _schema(source=_S, modified=_T, deleted=BooleanType(), bucket=_I)
CLASSIFICATION = _schema(
    category=_S, severity=_S, root_cause=_S, impacted_sector=_S, suggested_action=_S, confidence=_D)
DQ_REPORT = _schema(
    dt=_DAY, status=_S, reason=_S, checks=ArrayType(_S), row_count=_L, null_count=_L, out_of_range=_L)
MODEL_REGISTRY = _schema(
    version=_S, horizon=_I, path=_S, mae=_D, rmse=_D, mape=_D, naive_mae=_D, trained_on=_L,
    beats_naive=BooleanType(), origins=_I, mae_sd=_D)


class SchemaMismatch(ValueError):
    """A table lacks a declared column or holds it in another type."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of `df` in order; raises if one is missing or of another type.

    Only TIMESTAMP is accepted for TIMESTAMP_NTZ, and converted: files written by other
    tools mark UTC instants either way.
    """
    found = {f.name: f.dataType for f in df.schema}
    wrong, columns = [], []
    for field in schema:
        kind = found.get(field.name)
        if kind == field.dataType:
            columns.append(F.col(field.name))
        elif isinstance(field.dataType, TimestampNTZType) and isinstance(kind, TimestampType):
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            wrong.append(f"{field.name}: want {field.dataType.simpleString()}, "
                         f"have {kind.simpleString() if kind else 'nothing'}")
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*columns)
