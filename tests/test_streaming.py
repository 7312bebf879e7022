import random

from helpers import encounters, rows, t
from pyspark.sql import functions as F

from wardflow.operators.encode import hashing_encoder
from wardflow.operators.hourly import hourly_metrics_sparse
from wardflow.schemas import SILVER_ENCOUNTERS
from wardflow.streaming import files
from wardflow.streaming.hourly import hourly_metrics_stream
from wardflow.streaming.ingest import dedup_stream
from wardflow.streaming.knowledge import chunk_stream, document_files


def arrivals(spark, path):
    stream = files.read_files(spark, path, SILVER_ENCOUNTERS, files_per_batch=1)
    return stream.withColumn("arrival_time", files.instant("arrival_time"))


def deliver(spark, path, batch):
    encounters(spark, batch).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_for_closed_hours(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rnd, everything = random.Random(6), []
    for b in range(4):
        batch = [(f"{b}-{i}", t(f"{b * 5 + rnd.randrange(5):02d}:{rnd.randrange(60):02d}"), rnd.choice("AB"), rnd.randrange(1, 6))
                 for i in range(60)]
        everything += batch
        deliver(spark, src, batch)
        q = files.write_files(hourly_metrics_stream(arrivals(spark, src)), out, check)
        assert files.late_rows_dropped(q) == 0
    last = max(r[1] for r in everything)
    closed = (F.col("window_start") + F.expr("INTERVAL 1 HOUR")
              <= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 2 HOURS"))
    want = hourly_metrics_sparse(encounters(spark, everything)).where(closed)
    got = spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    key = ["sector_id", "window_start", "arrivals_count", "avg_triage_acuity"]
    assert rows(got, *key) == rows(want, *key) and want.count() > 10


def test_late_rows_are_counted_and_come_back_in_the_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    dropped = 0
    for batch in ([("a", t("08:10"), "A")], [("b", t("14:00"), "A")], [("late", t("08:20"), "A")], [("c", t("20:00"), "A")]):
        deliver(spark, src, batch)
        q = files.write_files(hourly_metrics_stream(arrivals(spark, src)), out, check)
        dropped += files.late_rows_dropped(q)
    assert dropped == 1
    got = spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert rows(got, "window_start", "arrivals_count") == [(t("08:00"), 1), (t("14:00"), 1)]
    batch = hourly_metrics_sparse(spark.read.schema(SILVER_ENCOUNTERS).parquet(src))
    assert rows(batch, "window_start", "arrivals_count")[0] == (t("08:00"), 2)


def test_repeated_deliveries_come_out_once(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for batch in ([("a", t("08:00"), "A"), ("a", t("08:00"), "A"), ("b", t("08:30"), "A")], [("a", t("08:00"), "A"), ("c", t("09:00"), "A")]):
        deliver(spark, src, batch)
        files.write_files(dedup_stream(arrivals(spark, src), "encounter_id", "arrival_time"), out, check)
    assert rows(spark.read.parquet(out), "encounter_id") == [("a",), ("b",), ("c",)]


def test_new_documents_are_chunked_once(spark, tmp_path):
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    texts = {"a.txt": "é" * 1500, "b.txt": "short"}
    for name, text in texts.items():
        (src / name).write_text(text, encoding="utf-8")
        chunks = chunk_stream(document_files(spark, str(src)), make_encoder=lambda: hashing_encoder(8))
        files.write_files(chunks, out, check)
    got = {}
    for r in spark.read.parquet(out).orderBy("source", "chunk_no").collect():
        got.setdefault(r.source.rsplit("/", 1)[1], []).append(r)
    assert {k: "".join(r.text for r in v) for k, v in got.items()} == texts
    assert all(len(r.vector) == 8 for v in got.values() for r in v)
