import datetime as dt
import glob
import json

import pytest
from helpers import bronze, encounters, events, metrics, rows, t
from pyspark.sql import functions as F

from wardflow.operators.quality import QualityGateFailed
from wardflow.plans import daily
from wardflow.schemas import (
    GOLD_FEATURES, GOLD_METRICS, PREDICTIONS, SECTORS, SILVER_ENCOUNTERS, SILVER_WAITS)
from wardflow.session import run_dir, shared_dir
from wardflow.sources import catalog, lake

DAY = dt.timedelta(days=1)
D1, D2, D3 = (dt.date(2024, 1, 1) + i * DAY for i in range(3))


def deliver(spark, root, day, per_hour=2, late=()):
    """Bronze of one day: arrivals in every hour, care after half an hour."""
    at = dt.datetime.combine(day, dt.time())
    enc, evt = [], []
    for h in range(24):
        for i in range(per_hour):
            arrive = at + dt.timedelta(hours=h, minutes=5 + i)
            key = f"{day}-{h}-{i}"
            enc.append((key, arrive.isoformat(sep=" "), "ER", "3", day))
            evt.append((key, "care_start", arrive + dt.timedelta(minutes=30), day))
    lake.append(bronze(spark, enc + list(late)), root, "bronze_encounters")
    lake.append(events(spark, evt).withColumn("event_timestamp", F.col("event_timestamp").cast("string")),
                root, "bronze_events")


def test_a_day_written_again_leaves_the_others_alone(spark, root):
    day1 = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("09:00"), "OR")])
    day2 = encounters(spark, [("c", t("2024-01-02 08:00"), "ER")])
    for df in (day1, day2, day2):
        lake.overwrite_days(df, root, "silver_encounters")
    back = lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS)
    assert rows(back, "encounter_id", "dt", "sector_id") == [("a", D1, "ER"), ("b", D1, "OR"), ("c", D2, "ER")]


def test_appending_nothing_adds_no_file(spark, root):
    for counts in ([1, 2, 3], [], [1, 2]):
        before = set(glob.glob(f"{root}/gold/**/*.parquet", recursive=True))
        lake.append(metrics(spark, counts), root, "gold_metrics")
        after = set(glob.glob(f"{root}/gold/**/*.parquet", recursive=True))
        assert before <= after and bool(after - before) == bool(counts)
    assert lake.read_table(spark, root, "gold_metrics").count() == 5


def test_only_the_day_asked_for_is_read(spark, root):
    lake.overwrite_days(encounters(spark, [("a", t("08:00"), "ER"), ("c", t("2024-01-02 08:00"), "ER")]),
                        root, "silver_encounters")
    one = lake.read_day(spark, root, "silver_encounters", D2, SILVER_ENCOUNTERS)
    assert rows(one, "encounter_id") == [("c",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert len(one.inputFiles()) == 2 and one.select("encounter_id").distinct().count() == 1


def test_missing_input_is_an_error(spark, root):
    with pytest.raises(lake.EmptyInput):
        lake.read_day(spark, root, "bronze_encounters", D1)
    deliver(spark, root, D1)
    with pytest.raises(lake.EmptyInput, match="bronze_encounters of 2024-01-02"):
        daily.bronze_to_silver(spark, root, D2)


def test_days_build_on_each_other_and_can_be_repeated(spark, root):
    for day in (D1, D2, D3, D2):
        if day != D2 or not glob.glob(f"{lake.path_of(root, 'bronze_encounters')}/dt={D2}"):
            deliver(spark, root, day, per_hour=day.day)
        daily.run_day(spark, root, day, spark.createDataFrame([("ER", "Ana", 3)], SECTORS))
    gold = lake.read_table(spark, root, "gold_metrics", GOLD_METRICS)
    assert gold.count() == 72 and gold.agg(F.sum("arrivals_count")).first()[0] == 24 * (1 + 2 + 3)
    features = lake.read_table(spark, root, "gold_features", GOLD_FEATURES)
    assert features.count() == 72, "lags across days must not empty the table"
    known = {r.window_start: r for r in features.collect()}
    noon = dt.datetime(2024, 1, 2, 12)
    assert (known[noon].lag_arrivals_24h, known[noon].target_arrivals_h24) == (1, 3)
    waits = lake.read_table(spark, root, "silver_waits", SILVER_WAITS)
    assert waits.count() == 144 and rows(waits.select("wait_service_min").distinct()) == [(30.0,)]
    ops = lake.read_table(spark, root, "gold_ops")
    # Nobody was discharged, so at 23:00 everyone treated on any day so far is in a bed.
    assert rows(ops.where("hour = 23"), "dt", "occupied_beds", "queue_size") == [(D1, 24, 0), (D2, 72, 0), (D3, 144, 0)]


def test_a_repeated_day_is_replaced_as_a_whole(spark, root):
    first = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("09:00"), "OR"), ("c", t("2024-01-02 08:00"), "OR")])
    lake.overwrite_days(first, root, "silver_encounters")
    moved = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("09:00"), "ER")])
    lake.overwrite_days(moved, root, "silver_encounters", [D1])
    stored = lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS)
    assert rows(stored, "encounter_id", "sector_id") == [("a", "ER"), ("b", "ER"), ("c", "OR")]
    lake.overwrite_days(moved.where("false"), root, "silver_encounters", [D1])
    assert rows(lake.read_table(spark, root, "silver_encounters", SILVER_ENCOUNTERS), "encounter_id") == [("c",)]


def test_a_late_discharge_reaches_its_stay(spark, root):
    lake.overwrite_days(encounters(spark, [("a", t("23:50"), "ER")]), root, "silver_encounters")
    lake.overwrite_days(events(spark, [("a", "care_start", t("23:55"))]), root, "silver_events")
    daily.build_waits(spark, root, D1)
    lake.overwrite_days(events(spark, [("a", "discharge", t("2024-01-04 10:30"))]), root, "silver_events")
    day = dt.date(2024, 1, 4)
    assert daily.days_with_news(spark, root, day) == [D1]
    sectors = spark.createDataFrame([("ER", "Ana", 3)], SECTORS)
    daily.build_load(spark, root, sectors, D3, D3)
    beds = lake.read_table(spark, root, "gold_ops").where(F.col("dt") == F.lit(D3))
    assert rows(beds.select("occupied_beds").distinct()) == [(1,)], "an open stay goes on"
    daily.build_waits(spark, root, D1)
    daily.build_load(spark, root, sectors, day, day)
    last = lake.read_table(spark, root, "gold_ops").where(F.col("dt") == F.lit(day))
    assert rows(last.where("occupied_beds > 0"), "hour") == [(h,) for h in range(11)]


def test_events_filed_the_day_after_count(spark, root):
    lake.overwrite_days(encounters(spark, [("a", t("23:50"), "ER")]), root, "silver_encounters")
    lake.overwrite_days(events(spark, [("a", "care_start", t("2024-01-02 00:20"))]), root, "silver_events")
    daily.build_waits(spark, root, D1)
    waits = lake.read_table(spark, root, "silver_waits", SILVER_WAITS)
    assert rows(waits, "dt", "total_wait_min") == [(D1, 30.0)]


def test_gate_stores_the_report_and_stops_the_day(spark, root):
    deliver(spark, root, D1, late=[("bad", "no time", "ER", "3", D1)])
    with pytest.raises(QualityGateFailed, match="too many nulls"):
        daily.run_day(spark, root, D1)
    report, = glob.glob(f"{root}/gold/data_quality_runs/dt={D1}/*.json")
    stored = json.loads(open(report).read())
    assert stored["status"] == "FAILED" and stored["null_count"] == 1 and stored["checks"] == ["existence", "time_range"]
    with pytest.raises(lake.EmptyInput):
        lake.read_day(spark, root, "gold_metrics", D1)
    daily.check_silver(spark, root, D1, max_null_rate=0.1)
    report, = glob.glob(f"{root}/gold/data_quality_runs/dt={D1}/*.json")
    assert json.loads(open(report).read())["status"] == "PASSED"


def test_gate_fails_a_day_without_rows(spark, root):
    lake.overwrite_days(encounters(spark, [("a", t("08:00"), "ER")]), root, "silver_encounters")
    with pytest.raises(QualityGateFailed, match="no rows"):
        daily.check_silver(spark, root, D2)


def test_a_stray_arrival_does_not_replace_another_day(spark, root):
    lake.overwrite_days(metrics(spark, [5] * 24, "ER"), root, "gold_metrics")
    stray = encounters(spark, [("x", t("12:10"), "ER")]).withColumn("dt", F.lit(D2))
    lake.overwrite_days(stray, root, "silver_encounters")
    daily.silver_to_gold(spark, root, D2)
    gold = lake.read_table(spark, root, "gold_metrics", GOLD_METRICS)
    assert gold.where(F.col("dt") == F.lit(D1)).count() == 24


def test_external_tables_and_views(spark, root):
    lake.overwrite_days(metrics(spark, [1, 2, 3, 4], start=t("07:00")), root, "gold_metrics")
    preds = spark.createDataFrame([("ER", t("10:00"), "v", 1.5, 2.0, 3.0, D1), ("ER", t("10:00"), "v", 9.0, 2.0, 3.0, D2)],
                                  PREDICTIONS)
    lake.append_predictions(preds, root, dt.datetime(2024, 1, 1, 10, 15))
    spark.sql(f"CREATE DATABASE tables_test LOCATION '{root}/db'")
    catalog.create_tables(spark, root, "tables_test")
    catalog.create_views(spark, "tables_test", "2024-01-01 10:30:00")
    assert rows(spark.table("tables_test.vw_current_status"), "window_start", "arrivals_count") == [
        (t("09:00"), 3), (t("10:00"), 4)]
    assert rows(spark.table("tables_test.vw_forecast_next_24h")) == [("ER", 1.5, D1)]
    assert dict(spark.table("tables_test.gold_ops_metrics_hourly").dtypes)["arrivals_count"] == "bigint"
    catalog.create_views(spark, "tables_test")
    assert spark.table("tables_test.vw_current_status").count() == 0, "without as_of the views follow the clock"


def test_documents_are_read_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("première\nligne\n\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("", encoding="utf-8")
    got = {r.source.rsplit("/", 1)[1]: r.text for r in lake.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "première\nligne\n\n"}, "an empty file has no row, as it has no chunk"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x").startswith(shared_dir(spark)) and run_dir(spark, "x") != run_dir(spark, "x")
