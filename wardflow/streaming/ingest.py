"""Incremental ingest: files taken once, repeated deliveries removed while they can still come."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wardflow.sources import ledger
from wardflow.streaming.files import LATENESS, read_files


def dedup_stream(df: DataFrame, key: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """The first delivery of each key within the watermark; `ts` must be zoned.

    The state holds keys no older than the watermark, not all keys ever seen.
    """
    return df.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def ingest_stream(spark: SparkSession, path: str, root: str, kind: str, checkpoint: str,
                  every: str | None = None, files_per_batch: int = 100) -> tuple[StreamingQuery, list[dt.date]]:
    """New files of `kind` under `path` become bronze; returns the query and the days with news so far.

    The ledger decides what is new: a micro-batch that is repeated, a checkpoint that was lost and a
    file that comes again under another name add nothing. Batches are bounded by their number of
    files. `every` ('15 minutes') keeps the query running.
    """
    schema, days = ledger.SCHEMAS[kind], []

    def work(batch: DataFrame, _: int) -> None:
        days.extend(d for d in ledger.take(batch, root, kind) if d not in days)

    files = read_files(spark, path, StructType([f for f in schema.fields if f.name != "dt"]), files_per_batch)
    writer = ledger.delivered(files, kind).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start(), days
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query, days
