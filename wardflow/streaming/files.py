"""File streams in and out. Every run stops when it has taken what was there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

LATENESS = "2 hours"
# Files dated long before the newest one seen are read like any others.
ANY_AGE = "36500d"


def read_files(spark: SparkSession, path: str, schema: StructType,
               files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files under a folder, or that match a pattern, each read once per checkpoint."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def instant(c: Column | str) -> Column:
    """A UTC wall-clock time as the zoned type that watermarks need."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def write_files(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Appends finished rows to `path`, exactly once, until the input is used up."""
    writer = df.writeStream.outputMode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    query.awaitTermination()
    return query


def written(spark: SparkSession, stream: DataFrame, path: str) -> DataFrame:
    """What write_files left at `path` for this stream; no rows if nothing was finished yet."""
    return spark.read.schema(stream.schema).parquet(path)


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them. They are not in the output; the
    batch run of their day brings them back."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
