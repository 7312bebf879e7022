"""Bronze from delivered files, each taken once, whatever is delivered or run again.

A file is known by its rows, not by its name: their number and two sums of 64-bit hashes. Rows of a
run land in folders of their own, days with news are rebuilt from all landed runs that count, and
the ledger is written last. A run that fails before that counts for nothing and is replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.schemas import BRONZE_ENCOUNTERS, BRONZE_EVENTS, INGEST_LEDGER
from wardflow.sources import lake

SCHEMAS = {"encounters": BRONZE_ENCOUNTERS, "events": BRONZE_EVENTS}
TIMES = {"encounters": "arrival_time", "events": "event_timestamp"}


def delivered(files: DataFrame, kind: str, day: dt.date | None = None) -> DataFrame:
    """Rows of delivered files as bronze, with `_file`: all text, filed under `day`, or else under the
    day of their own time, or of the file where that cannot be read."""
    meta = F.col("_metadata")
    own = F.coalesce(F.to_date(F.try_to_timestamp(F.col(TIMES[kind]).cast("string"))),
                     F.to_date(meta["file_modification_time"]))
    columns = [F.col(c).cast("string").alias(c) for c in SCHEMAS[kind].fieldNames() if c != "dt"]
    return files.select(*columns, (own if day is None else F.lit(day)).alias("dt"), meta["file_path"].alias("_file"))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All files that runs have met: `added`, or `repeated` where their rows were known."""
    try:
        return lake.read_table(spark, root, "ingest_ledger", INGEST_LEDGER)
    except lake.EmptyInput:
        return spark.createDataFrame([], INGEST_LEDGER).withColumn("run_ts", F.lit(""))


def _files(rows: DataFrame) -> dict[str, dict]:
    """What each file holds; the driver gets one row per file and day."""
    names = [c for c in rows.columns if c not in ("_file", "dt")]

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), *names).cast("decimal(20,0)"))
    found: dict[str, dict] = {}
    for r in rows.groupBy("_file", "dt").agg(
            F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).collect():
        f = found.setdefault(r["_file"], {"n": 0, "a": 0, "b": 0, "days": {}})
        f["n"], f["a"], f["b"] = f["n"] + r.n, f["a"] + int(r.a), f["b"] + int(r.b)
        f["days"][r.dt] = r.n
    for f in found.values():
        f["content"] = f"{f['n']}-{f['a'] % 2**64:016x}-{f['b'] % 2**64:016x}"
    return found


def _adopt(spark: SparkSession, root: str, kind: str, days: list[dt.date], landed: set[dt.date]) -> None:
    """Bronze rows that were there before a day's first landing land as a run of their own."""
    left = [d for d in days if d not in landed]
    try:
        bronze = lake.read_table(spark, root, f"bronze_{kind}")
    except lake.EmptyInput:
        return
    columns = [F.col(c).cast("string").alias(c) for c in SCHEMAS[kind].fieldNames() if c != "dt"]
    lake.replace_run(bronze.where(F.col("dt").isin(left)).select(*columns, "dt"), root, f"landed_{kind}", f"{kind}-adopted")


def take(rows: DataFrame, root: str, kind: str) -> list[dt.date]:
    """Adds the files of `rows` (see `delivered`) that the ledger does not know to bronze; returns the
    days that have news. The files of one call are listed on the driver."""
    spark, table = rows.sparkSession, f"landed_{kind}"
    files = _files(rows)
    if not files:
        return []
    before = ledger(spark, root).where((F.col("source_table") == kind) & (F.col("status") == "added"))
    known = {r.content for r in before.where(F.col("content").isin([f["content"] for f in files.values()]))
             .select("content").distinct().collect()}
    high = before.agg(F.max("last_day")).first()[0]
    new, records = [], []
    for name, f in sorted(files.items()):
        fresh = f["content"] not in known
        known.add(f["content"])
        if fresh:
            new.append(name)
        late = sum(n for d, n in f["days"].items() if fresh and high is not None and d < high)
        records.append((kind, name, f["content"], f["n"], late, max(f["days"]), "added" if fresh else "repeated"))
    run = f"{kind}-{'' if new else 'repeated-'}" + hashlib.sha256(
        "\n".join(sorted(files[n]["content"] for n in new) or sorted(files)).encode()).hexdigest()[:24]

    days = sorted({d for n in new for d in files[n]["days"]})
    if days:
        try:
            landed = lake.read_table(spark, root, table, first=days[0], last=days[-1])
            there = {r.dt for r in landed.select("dt").distinct().collect()}
        except lake.EmptyInput:
            there = set()
        _adopt(spark, root, kind, days, there)
        lake.replace_run(rows.where(F.col("_file").isin(new)).drop("_file"), root, table, run)
        counts = before.select("run_ts").distinct()
        landed = lake.read_table(spark, root, table, SCHEMAS[kind], days[0], days[-1]).where(F.col("dt").isin(days))
        # Runs that never reached the ledger are no part of the day.
        ours = F.col("run_ts").isin(run, f"{kind}-adopted")
        kept = landed.where(ours).unionByName(landed.where(~ours).join(counts, "run_ts", "left_semi"))
        lake.overwrite_days(kept.select(*SCHEMAS[kind].fieldNames()), root, f"bronze_{kind}", days)
    lake.replace_run(spark.createDataFrame(records, INGEST_LEDGER).coalesce(1), root, "ingest_ledger", run)
    return days
