"""Command line: one step per call, for a scheduler or spark-submit.

    python -m wardflow.jobs --root <folder> --date 2024-01-15 bronze-to-silver
"""

from __future__ import annotations

import argparse
import datetime as dt
import zlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.texts import CHUNK_CHARS
from wardflow.operators.classify import classify, validate
from wardflow.operators.encode import embed
from wardflow.operators.retrieval import top_k_similar, with_context
from wardflow.operators.status import predictions_preview
from wardflow.operators.texts import split_rejects
from wardflow.plans import daily
from wardflow.schemas import GOLD_FEATURES, SECTORS
from wardflow.session import build_session
from wardflow.sources import catalog, lake, ledger, models
from wardflow.streaming.ingest import ingest_stream
from wardflow.streaming.files import read_files
from wardflow.streaming.knowledge import changed_files, upsert_documents
from wardflow.streaming.score import score_latest_stream


def _ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """Files delivered under --input/encounters and --input/events become bronze of the day."""
    for kind in ledger.SCHEMAS:
        df = lake.require_rows(spark.read.parquet(f"{a.input}/{kind}"), f"{a.input}/{kind}")
        ledger.take(ledger.delivered(df, kind, a.date), a.root, kind)


def _stream_ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """As ingest-bronze for files not met before, filed under the days of their rows; with --every it goes on.
    Writes the days with news, one per line, to --output if it is named."""
    queries, news = [], set()
    for kind in ledger.SCHEMAS:
        query, days = ingest_stream(spark, f"{a.input}/{kind}", a.root, kind, f"{a.root}/_checkpoints/ingest-{kind}", a.every)
        queries.append(query)
        news |= set(days)
    if a.every:
        for query in queries:
            query.awaitTermination()
    elif a.output and news:
        spark.createDataFrame([(d,) for d in sorted(news)], "dt date").coalesce(1).write.mode("overwrite").json(a.output)


def _kb_ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """New files are chunked and embedded, replaced ones anew, and the chunks of deleted ones removed."""
    upsert_documents(changed_files(spark, a.input, a.root), a.root, a.chunk_chars)


def _kb_query(spark: SparkSession, a: argparse.Namespace) -> None:
    """Queries from a JSON-lines file with `query_id` and `text`; writes context and citations."""
    asked, rejected = split_rejects(spark.read.schema("query_id string, text string").json(a.input))
    corpus = spark.read.parquet(lake.path_of(a.root, "kb_chunks")).withColumn(
        "chunk_id", F.concat_ws("#", "source", F.col("chunk_no").cast("string")))
    # A question without a known word resembles nothing and has no context.
    hits = top_k_similar(corpus, embed(asked), a.k, corpus_id="chunk_id", query_id="query_id", above=0.0)
    with_context(lake.stored(hits), corpus, "chunk_id").write.mode("overwrite").parquet(a.output)
    rejected.write.mode("overwrite").parquet(f"{a.output}_rejected")


def _classify(spark: SparkSession, a: argparse.Namespace) -> None:
    """Texts from a JSON-lines file with `id` and `text`, classified by a stored model; valid
    records join their table, the rest goes to `--output`."""
    texts, rejected = split_rejects(spark.read.schema("id string, text string").json(a.input))
    kind, severity = a.labels
    named = [r.sector_id for r in _sectors(spark, a).select("sector_id").na.drop().distinct().collect()] if a.sectors else []
    out = classify(texts, PipelineModel.load(a.model), kind, severity, tuple(a.kinds), sectors=sorted(named))
    checked = validate(out.select("id", "classification.*"))
    good = checked.where(F.col("problem").isNull()).drop("problem").withColumn("dt", F.lit(a.date))
    # A run is its day and its input: classified again, they replace what they left.
    run = f"{a.date:%Y%m%d}-{zlib.crc32(a.input.encode()):08x}"
    lake.replace_run(good, a.root, "gold_classifications", run)
    broken = checked.where(F.col("problem").isNotNull()).select("id", F.col("problem").alias("reason"))
    rejected.select("id", "reason").unionByName(broken).write.mode("overwrite").parquet(a.output)


def _preview(spark: SparkSession, a: argparse.Namespace) -> None:
    df = lake.read_table(spark, a.root, "gold_predictions", None, a.date, a.date)
    lake.export_csv(predictions_preview(df), a.output)


def _sectors(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The sector table from a CSV file with a header."""
    return spark.read.schema(SECTORS).option("header", True).csv(a.sectors)


def _stream_score(spark: SparkSession, a: argparse.Namespace) -> None:
    """Feature files not scored before, by the newest model; with --every the query goes on."""
    version, fitted = models.load_latest(spark, a.root)
    rows = read_files(spark, f"{lake.path_of(a.root, 'gold_features')}/dt=*", GOLD_FEATURES)
    query = score_latest_stream(rows, fitted, version, a.root, f"{a.root}/_checkpoints/score-{version}", a.every)
    if a.every:
        query.awaitTermination()


def _tables(spark: SparkSession, a: argparse.Namespace) -> None:
    """External tables and views, in a catalog that outlives this process."""
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        raise RuntimeError("the catalog of this session ends with it; set a persistent one")
    catalog.create_tables(spark, a.root, a.database)
    catalog.create_views(spark, a.database)


STEPS = {
    "ingest-bronze": _ingest,
    "stream-ingest": _stream_ingest,
    "bronze-to-silver": lambda s, a: daily.bronze_to_silver(s, a.root, a.date),
    "dq-check": lambda s, a: daily.check_silver(s, a.root, a.date, a.max_null_rate),
    "waits": lambda s, a: daily.build_waits(s, a.root, a.date),
    "load": lambda s, a: daily.update_load(s, a.root, _sectors(s, a), [a.date]),
    "silver-to-gold": lambda s, a: daily.silver_to_gold(s, a.root, a.date),
    "features": lambda s, a: daily.build_features(s, a.root, a.date),
    "run-day": lambda s, a: daily.run_day(s, a.root, a.date, _sectors(s, a) if a.sectors else None),
    "train": lambda s, a: daily.train(s, a.root, a.as_of, a.days, a.origins),
    "score": lambda s, a: daily.score(s, a.root, a.as_of),
    "sketch": lambda s, a: daily.sketch_days(s, a.root, [a.date]),
    "drift": lambda s, a: (daily.drift(s, a.root, a.date - dt.timedelta(days=a.days - 1), a.date)
                           .coalesce(1).write.mode("overwrite").json(a.output)),
    "stream-score": _stream_score,
    "tables": _tables,
    "kb-ingest": _kb_ingest,
    "kb-query": _kb_query,
    "classify": _classify,
    "preview": _preview,
}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="wardflow.jobs")
    p.add_argument("step", choices=STEPS)
    p.add_argument("--root", required=True, help="folder of the layers, shared by all executors")
    p.add_argument("--date", type=dt.date.fromisoformat)
    p.add_argument("--as-of", type=dt.datetime.fromisoformat, help="moment of training or scoring, UTC")
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--every", help="keep a stream running, e.g. '15 minutes'")
    p.add_argument("--sectors", help="CSV with sector_id, manager, functional_capacity; for the load, and names that classify looks for")
    p.add_argument("--database", default="default")
    p.add_argument("--days", type=int, default=7, help="held-out days of training, current days of drift")
    p.add_argument("--origins", type=int, default=1, help="cut-offs at which training is measured")
    p.add_argument("--k", type=int, default=3)
    p.add_argument("--chunk-chars", type=int, default=CHUNK_CHARS)
    p.add_argument("--max-null-rate", type=float, default=0.0)
    p.add_argument("--model", help="folder of a stored text model")
    p.add_argument("--labels", nargs=2, help="label of the kind, label of the severity")
    p.add_argument("--kinds", nargs=2, help="category for kind 0 and for kind 1")
    a = p.parse_args(argv)
    if a.as_of is None and a.step in ("train", "score"):
        a.as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    STEPS[a.step](build_session(), a)


if __name__ == "__main__":
    main()
