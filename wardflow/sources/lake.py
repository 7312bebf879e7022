"""Reading and writing the layers: Parquet in dt=... folders on a shared file system."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardflow.schemas import DQ_REPORT
from wardflow.session import run_dir

# Table -> (folder under the root, partition columns).
TABLES = {
    "bronze_encounters": ("bronze/encounters_raw", ("dt",)),
    "bronze_events": ("bronze/events_raw", ("dt",)),
    "landed_encounters": ("landing/encounters", ("dt", "run_ts")),
    "landed_events": ("landing/events", ("dt", "run_ts")),
    "ingest_ledger": ("landing/ledger", ("run_ts",)),
    "silver_encounters": ("silver/encounters", ("dt",)),
    "silver_events": ("silver/events", ("dt",)),
    "silver_rejects": ("silver/rejects", ("dt",)),
    "silver_waits": ("silver/encounter_waits", ("dt",)),
    "gold_metrics": ("gold/ops_metrics_hourly", ("dt",)),
    "gold_ops": ("gold/ops_load_hourly", ("dt",)),
    "load_changes": ("gold/load_changes_hourly", ("dt",)),
    "load_balances": ("gold/load_balances", ("dt",)),
    "gold_features": ("gold/features", ("dt",)),
    "gold_predictions": ("gold/predictions", ("dt", "run_ts")),
    "gold_sketches": ("gold/column_sketches", ("dt",)),
    "gold_quality": ("gold/data_quality_runs", ("dt",)),
    "gold_classifications": ("gold/classifications", ("dt", "run_ts")),
    "kb_chunks": ("kb/chunks", ("bucket",)),
    "kb_sources": ("kb/sources", ("bucket",)),
}

FILES = 8              # of a bucket, beyond which they are put together
SMALL_FILE = 16 << 20  # if they have fewer bytes on average


class EmptyInput(RuntimeError):
    """There is nothing to work on; a job must not end as if it had succeeded."""


def path_of(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{TABLES[table][0]}"


def _parquet(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise EmptyInput(f"no data at {path}") from e
        raise


def read_table(spark: SparkSession, root: str, table: str, schema: StructType | None = None,
               first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """A table, or only its days from `first` to `last`; other day folders are not opened."""
    df = _parquet(spark, path_of(root, table), schema)
    if "run_ts" in TABLES[table][1]:
        # Read off folder names, where a run of digits alone looks like a number.
        df = df.withColumn("run_ts", F.col("run_ts").cast("string"))
    if first is not None:
        df = df.where(F.col("dt") >= F.lit(first))
    if last is not None:
        df = df.where(F.col("dt") <= F.lit(last))
    return df


def table_or_empty(spark: SparkSession, root: str, table: str, schema: StructType,
                   first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """As `read_table`, without rows where nothing has been written yet."""
    try:
        return read_table(spark, root, table, schema, first, last)
    except EmptyInput:
        return no_rows(spark, schema)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that starts no Python worker and is known to be empty when a join is planned."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_day(spark: SparkSession, root: str, table: str, day: dt.date,
             schema: StructType | None = None) -> DataFrame:
    """One day of a table; raises EmptyInput if it holds no row."""
    return require_rows(read_table(spark, root, table, schema, day, day), f"{table} of {day}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInput(f"no rows in {what}")
    return df


def rebalanced(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows of one folder together, as few files as fit; a folder that is too large for one
    task is split by adaptive execution, so a hot sector does not end in a single writer."""
    return df.hint("rebalance", *by) if by else df


def _write(df: DataFrame, root: str, table: str, mode: str) -> None:
    _, by = TABLES[table]
    (rebalanced(df, by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path_of(root, table)))


def overwrite_days(df: DataFrame, root: str, table: str, days: Iterable[dt.date] = ()) -> None:
    """Replaces the days that `df` has rows for, and empties those of `days` that it has none
    for; all others are left alone. A day is one folder, so it is replaced as a whole, whatever
    sectors it had before."""
    days = set(days)
    rows = df.persist(StorageLevel.DISK_ONLY) if days else df
    try:
        _write(rows, root, table, "overwrite")
        if days:
            # One row per day that was written.
            for day in days - {r.dt for r in rows.select("dt").distinct().collect()}:
                empty = rows.where(F.lit(False)).drop("dt")
                empty.write.mode("overwrite").parquet(f"{path_of(root, table)}/dt={day.isoformat()}")
    finally:
        if days:
            rows.unpersist()


def append(df: DataFrame, root: str, table: str) -> None:
    """Adds new files to the partitions of `df`; without rows no file is written."""
    _write(df, root, table, "append")


def replace_run(df: DataFrame, root: str, table: str, run_ts: str) -> None:
    """Rows of one run beside those of others. The run's own folders are replaced, so a run that is
    repeated leaves no double rows."""
    _write(df.withColumn("run_ts", F.lit(run_ts)), root, table, "overwrite")


def append_predictions(df: DataFrame, root: str, run_ts: dt.datetime) -> None:
    """Predictions of one run, marked with the minute it ran."""
    replace_run(df, root, "gold_predictions", run_ts.strftime("%Y%m%d%H%M"))


def replace_buckets(df: DataFrame, root: str, table: str, emptied: Iterable[int] = ()) -> None:
    """Replaces the buckets that `df` has rows for, and empties those of `emptied`; all others are left
    alone. `df` may read the table itself: old files go when all new ones are written. Each task
    adds a file to each bucket it has rows of, so `df` should come from files of the table or be rebalanced."""
    _, by = TABLES[table]
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path_of(root, table))
    none = no_rows(df.sparkSession, df.drop(*by).schema)
    for b in emptied:
        none.write.mode("overwrite").parquet(f"{path_of(root, table)}/bucket={b}")


def fragmented(df: DataFrame, folders: int) -> bool:
    """Whether a table that is read from `folders` folders has many files that are small."""
    if not df.inputFiles():
        return False
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    n, size = files.agg(F.count(F.lit(1)), F.sum("file_size")).first()
    return n > FILES * folders and size < n * SMALL_FILE


def write_report(report: DataFrame, root: str) -> None:
    """One JSON object per day in its dt=... folder. The report has one row per day."""
    (report.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").json(path_of(root, "gold_quality")))


def read_reports(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    days = spark.read.schema(DQ_REPORT).json(path_of(root, "gold_quality"))
    return days.where(F.col("dt").between(F.lit(first), F.lit(last)))


def stored(df: DataFrame) -> DataFrame:
    """`df` written to a new table in the shared folder and read back.

    Lineage ends there, it is computed once, and joins know its true size: Spark then
    broadcasts it if it is below the threshold, where an estimate would shuffle the other side.
    """
    path = run_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def spread(df: DataFrame) -> DataFrame:
    """A plain scan for costly work per row: if its files give fewer tasks than there are
    cores, the rows are dealt out again; a scan of many files is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """`source, text` of UTF-8 files, one row per file; source is the file path."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))
