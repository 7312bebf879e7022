"""The knowledge base follows its documents: new, replaced, deleted, late."""

import datetime as dt
import os

from helpers import rows
from pyspark.sql import functions as F

from wardflow import jobs
from wardflow.schemas import KB_SOURCES, KB_STORED
from wardflow.sources import lake
from wardflow.streaming import files
from wardflow.streaming.knowledge import changed_files, upsert_documents, upsert_stream

VERSION = "source string, modified timestamp_ntz, text string, deleted boolean"


def at(hour):
    return dt.datetime(2024, 1, 1, hour)


def put(spark, root, *versions, **options):
    upsert_documents(spark.createDataFrame(list(versions), VERSION), root, **options)


def kb(spark, root):
    return rows(lake.read_table(spark, root, "kb_chunks", KB_STORED), "source", "chunk_no", "text")


def test_a_newer_version_takes_the_place_of_all_old_chunks(spark, root):
    put(spark, root, ("a", at(1), "x" * 2500, False), ("b", at(1), "other", None), (None, at(1), "no source", False))
    assert [r[:2] for r in kb(spark, root)] == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    put(spark, root, ("a", at(2), "short", False))
    assert kb(spark, root) == [("a", 0, "short"), ("b", 0, "other")]
    put(spark, root, ("a", at(1), "late and old", False))
    assert kb(spark, root) == [("a", 0, "short"), ("b", 0, "other")]
    put(spark, root, ("a", at(3), "one of two in a batch", False), ("a", at(4), "newest", False))
    assert kb(spark, root) == [("a", 0, "newest"), ("b", 0, "other")]


def test_deleted_sources_stay_away(spark, root):
    put(spark, root, ("a", at(1), "text", False), ("b", at(1), "kept", False), buckets=1)
    put(spark, root, ("a", at(3), None, True), buckets=1)
    put(spark, root, ("a", at(2), "late", False), buckets=1)
    assert kb(spark, root) == [("b", 0, "kept")]
    marks = lake.read_table(spark, root, "kb_sources", KB_SOURCES)
    assert rows(marks, "source", "modified", "deleted") == [("a", at(3), True), ("b", at(1), False)]
    put(spark, root, ("b", at(5), None, True), buckets=1)
    assert kb(spark, root) == [], "an emptied bucket is emptied"
    put(spark, root, ("a", at(6), "back", False), buckets=1)
    assert kb(spark, root) == [("a", 0, "back")]


def test_repeated_batches_and_empty_ones_change_nothing(spark, root):
    batch = [("a", at(1), "x" * 1200, False), ("a", at(1), "x" * 1200, False), ("b", at(1), "", False)]
    for _ in range(2):
        put(spark, root, *batch)
    put(spark, root)
    assert [r[:2] for r in kb(spark, root)] == [("a", 0), ("a", 1)]
    chunk = lake.read_table(spark, root, "kb_chunks", KB_STORED).first()
    assert len(chunk.vector) > 0


def test_only_buckets_of_changed_sources_are_written(spark, root):
    put(spark, root, *[(f"s{i}", at(1), "text", False) for i in range(40)], buckets=8)
    folder = lake.path_of(root, "kb_chunks")

    def files_of():
        return {(b, f) for b in os.listdir(folder) if b.startswith("bucket=") for f in os.listdir(f"{folder}/{b}") if f.endswith(".parquet")}

    before = files_of()
    put(spark, root, ("s1", at(2), "new", False), buckets=8)
    changed = {b for b, _ in before ^ files_of()}
    assert len(changed) == 1 and len({b for b, _ in before}) > 4


def _files(root):
    folder = lake.path_of(root, "kb_chunks")
    return {f"{b}/{f}" for b in os.listdir(folder) if b.startswith("bucket=")
            for f in os.listdir(f"{folder}/{b}") if f.endswith(".parquet")}


def test_versions_without_news_write_nothing(spark, root):
    put(spark, root, *[(f"s{i}", at(2), "text", False) for i in range(20)], buckets=4)
    before = _files(root)
    put(spark, root, *[(f"s{i}", at(1), "older", False) for i in range(20)], buckets=4)
    assert before and _files(root) == before


def test_small_files_are_put_together(spark, root):
    n = 2 * lake.FILES
    for i in range(n):
        put(spark, root, (f"s{i}", at(1), f"text {i}", False), buckets=1)
    assert len(_files(root)) <= lake.FILES + 2
    assert kb(spark, root) == sorted((f"s{i}", 0, f"text {i}") for i in range(n))


def test_stream_of_versions(spark, root, tmp_path):
    src = str(tmp_path / "versions")
    for i, version in enumerate([("a", at(1), "one", False), ("a", at(2), "two", False), ("b", at(1), "b", False)]):
        df = spark.createDataFrame([version], VERSION)
        df.write.mode("append").parquet(f"{src}/part={i}")
        upsert_stream(files.read_files(spark, f"{src}/part=*", df.schema), root, f"{root}/_checkpoint")
    assert kb(spark, root) == [("a", 0, "two"), ("b", 0, "b")]


def test_files_replaced_and_removed(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda: spark)
    docs = tmp_path / "docs"
    docs.mkdir()

    def write(name, text, second):
        (docs / name).write_text(text, encoding="utf-8")
        os.utime(docs / name, (1_700_000_000 + second,) * 2)

    def ingest():
        jobs.main(["--root", root, "--input", str(docs), "kb-ingest"])
        return [(s.rsplit("/", 1)[1], n, text) for s, n, text in kb(spark, root)]

    write("a.txt", "primeira versão", 0)
    write("b.txt", "fica", 50)
    assert ingest() == [("a.txt", 0, "primeira versão"), ("b.txt", 0, "fica")]
    assert changed_files(spark, str(docs), root).count() == 0
    write("a.txt", "segunda versão", 10)
    assert ingest() == [("a.txt", 0, "segunda versão"), ("b.txt", 0, "fica")]
    (docs / "b.txt").rename(tmp_path / "b.txt")
    assert ingest() == [("a.txt", 0, "segunda versão")]


def test_retried_runs_replace_their_rows(spark, root):
    df = spark.createDataFrame([("ER", dt.date(2024, 1, 1), 1.5)], "sector_id string, dt date, predicted double")
    for minute in (0, 15, 15):
        lake.append_predictions(df, root, dt.datetime(2024, 1, 1, 6, minute))
    got = lake.read_table(spark, root, "gold_predictions").select(F.col("run_ts").cast("string").alias("run_ts"), "predicted")
    assert rows(got) == [("202401010600", 1.5), ("202401010615", 1.5)]
