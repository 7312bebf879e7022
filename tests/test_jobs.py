import csv
import datetime as dt
import glob
import json

import pytest
from helpers import bronze, events, rows, t

from wardflow import jobs
from wardflow.operators.classify import fit_text_models
from wardflow.sources import lake, ledger

DAY = dt.date(2024, 1, 1)


@pytest.fixture(autouse=True)
def same_session(spark, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda: spark)


def run(root, step, *more):
    jobs.main(["--root", root, *more, step])


def test_a_day_from_the_command_line(spark, root, tmp_path):
    src = str(tmp_path / "delivered")
    bronze(spark, [(f"e{h}", f"2024-01-01 {h:02d}:10:00", "ER", "3", DAY) for h in range(24)]).drop("dt").write.parquet(f"{src}/encounters")
    events(spark, [(f"e{h}", "care_start", t(f"{h:02d}:40")) for h in range(24)]).drop("dt").write.parquet(f"{src}/events")
    run(root, "ingest-bronze", "--date", str(DAY), "--input", src)
    for step in ("bronze-to-silver", "dq-check", "waits", "silver-to-gold", "features"):
        run(root, step, "--date", str(DAY))
    assert lake.read_table(spark, root, "gold_features").count() == 24
    with pytest.raises(lake.EmptyInput):
        run(root, "silver-to-gold", "--date", "2024-01-02")


def test_tables_need_a_catalog_that_lasts(root):
    with pytest.raises(RuntimeError, match="persistent"):
        run(root, "tables")


def test_streamed_files_are_taken_once_and_filed_by_their_own_day(spark, root, tmp_path):
    src, out = str(tmp_path / "delivered"), str(tmp_path / "news")
    made = [(f"e{h}", f"2024-01-0{1 + h % 2} {h:02d}:10:00", "ER", "3", DAY) for h in range(24)]
    bronze(spark, made).drop("dt").write.parquet(f"{src}/encounters")
    told = events(spark, [(f"e{h}", "care_start", t(f"{h:02d}:40")) for h in range(24)]).drop("dt")
    told.withColumn("event_timestamp", told["event_timestamp"].cast("string")).write.parquet(f"{src}/events")
    for _ in range(2):
        run(root, "stream-ingest", "--input", src, "--output", out)
    assert rows(lake.read_table(spark, root, "bronze_encounters").groupBy("dt").count(), "dt", "count") == [
        (DAY, 12), (DAY + dt.timedelta(days=1), 12)]
    assert lake.read_table(spark, root, "bronze_events").count() == 24
    assert rows(spark.read.schema("dt date").json(out)) == [(DAY,), (DAY + dt.timedelta(days=1),)]
    run(root, "bronze-to-silver", "--date", str(DAY))
    assert lake.read_table(spark, root, "silver_encounters").count() == 12


def test_drift_from_the_command_line(spark, root, tmp_path):
    src, out = str(tmp_path / "delivered"), str(tmp_path / "drift")
    for day in (1, 2):
        # One arrival an hour on the first day, three on the second.
        made = [(f"{day}-{h}-{i}", f"2024-01-0{day} {h:02d}:1{i}:00", "ER", "3", DAY) for h in range(24) for i in range(2 * day - 1)]
        bronze(spark, made).drop("dt").write.parquet(f"{src}/day{day}")
    for day in (1, 2):
        ledger.take(ledger.delivered(spark.read.parquet(f"{src}/day{day}"), "encounters"), root, "encounters")
        for step in ("bronze-to-silver", "silver-to-gold", "features"):
            run(root, step, "--date", f"2024-01-0{day}")
    run(root, "drift", "--date", "2024-01-02", "--days", "1", "--output", out)
    found = {r.feature: r for r in spark.read.json(out).collect()}
    assert (found["arrivals_count"].baseline_rows, found["arrivals_count"].current_rows) == (24, 24)
    assert found["arrivals_count"].psi > 10 and set(found) == {"arrivals_count", "rolling_avg_arrivals_4h", "lag_arrivals_24h"}


def test_questions_to_the_knowledge_base(spark, root, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "triage.txt").write_text("Regra da sala verde: ouvir primeiro quem chega de maca", encoding="utf-8")
    (docs / "window.txt").write_text("Estoque de luvas contado cada quinta", encoding="utf-8")
    for _ in range(2):
        run(root, "kb-ingest", "--input", str(docs))
    assert lake.read_table(spark, root, "kb_chunks").count() == 2
    asked, out = tmp_path / "asked.json", str(tmp_path / "answers")
    asked.write_text("\n".join(json.dumps(q) for q in (
        {"query_id": "q1", "text": "quem chega de maca"}, {"query_id": "q2", "text": ""})), encoding="utf-8")
    run(root, "kb-query", "--input", str(asked), "--output", out, "--k", "1")
    answer, = spark.read.parquet(out).collect()
    assert answer.context.startswith("Regra") and answer.citations[0].endswith("triage.txt")
    assert rows(spark.read.parquet(f"{out}_rejected"), "query_id", "status_code") == [("q2", 400)]


def test_texts_are_classified_and_stored(spark, root, tmp_path):
    known = spark.createDataFrame([("monitor broken alarm", 1, 1), ("lab results late", 0, 0)] * 10,
                                  "text string, kind int, severe int")
    fit_text_models(known, ["kind", "severe"], str(tmp_path / "model"))
    told = tmp_path / "told.json"
    told.write_text("\n".join(json.dumps(x) for x in (
        {"id": "a", "text": "alarm monitor broken in ER"}, {"id": "b", "text": "results late"}, {"id": "c", "text": ""})),
        encoding="utf-8")
    sectors = tmp_path / "sectors.csv"
    sectors.write_text("sector_id,manager,functional_capacity\nER,Ana,10\nICU,Rui,5\n")
    out = str(tmp_path / "rejected")
    run(root, "classify", "--date", str(DAY), "--input", str(told), "--output", out, "--model",
        str(tmp_path / "model"), "--labels", "kind", "severe", "--kinds", "Delay", "Equipment Failure", "--sectors", str(sectors))
    stored = lake.read_table(spark, root, "gold_classifications")
    assert rows(stored, "id", "category", "severity", "dt") == [
        ("a", "Equipment Failure", "Critical", DAY), ("b", "Delay", "Low", DAY)]
    why = {r.id: (set((r.root_cause or "").split(", ")), r.impacted_sector) for r in stored.collect()}
    assert why == {"a": ({"alarm", "broken", "monitor"}, "ER"), "b": ({""}, None)}
    assert rows(spark.read.parquet(out)) == [("c", "No text provided")]


def test_preview_as_csv(spark, root, tmp_path):
    from wardflow.schemas import PREDICTIONS
    df = spark.createDataFrame([("ER", t("10:00"), "v", 1.236, 2.0, 0.125, DAY)], PREDICTIONS)
    lake.append_predictions(df, root, dt.datetime(2024, 1, 1, 10, 15))
    run(root, "preview", "--date", str(DAY), "--output", str(tmp_path / "csv"))
    line, = [r for f in glob.glob(f"{tmp_path}/csv/*.csv") for r in csv.DictReader(open(f))]
    assert (line["prediction_ts"], line["predicted_arrivals_h1"], line["predicted_arrivals_h24"]) == ("2024-01-01 10:00:00", "1.24", "0.12")
