"""Deliveries that silver does not take, and what the gate makes of them."""

import datetime as dt

import pytest
from helpers import bronze, events, rows, t

from wardflow.operators.quality import QualityGateFailed
from wardflow.plans import daily
from wardflow.schemas import GOLD_FEATURES, SILVER_REJECTS
from wardflow.sources import lake
from wardflow.streaming.files import read_files
from wardflow.streaming.score import score_latest_stream

DAY = dt.date(2024, 1, 1)


def deliver(spark, root, encounters, steps=()):
    lake.append(bronze(spark, encounters), root, "bronze_encounters")
    evt = events(spark, list(steps) or [("a", "care_start", t("09:00"))])
    lake.append(evt.withColumn("event_timestamp", evt["event_timestamp"].cast("string")), root, "bronze_events")


def row(name, when="2024-01-01 08:00:00"):
    return (name, when, "ER", "3", DAY)


def test_null_ids_are_counted_as_delivered(spark, root):
    deliver(spark, root, [row(None)] * 50 + [row(f"e{i}") for i in range(50)])
    daily.bronze_to_silver(spark, root, DAY)
    assert lake.read_table(spark, root, "silver_encounters").count() == 50
    assert lake.read_table(spark, root, "silver_rejects", SILVER_REJECTS).count() == 50
    with pytest.raises(QualityGateFailed, match="encounter_id"):
        daily.check_silver(spark, root, DAY, max_null_rate=0.4)
    assert daily.check_silver(spark, root, DAY, max_null_rate=0.5).first().row_count == 100


def test_reasons_and_records(spark, root):
    deliver(spark, root, [row("a"), row("", "2024-01-01 09:00:00"), row("b", "soon"), row("b", "soon"), row("c", None)])
    daily.bronze_to_silver(spark, root, DAY)
    found = lake.read_table(spark, root, "silver_rejects", SILVER_REJECTS)
    assert rows(found, "source_table", "reason") == [
        ("bronze_encounters", "arrival_time not readable")] * 3 + [("bronze_encounters", "no encounter_id")]
    assert '"arrival_time":"soon"' in found.where("record LIKE '%soon%'").first().record
    assert rows(lake.read_table(spark, root, "silver_encounters"), "encounter_id") == [("a",)]
    # A corrected delivery of the day empties the table again.
    lake.overwrite_days(bronze(spark, [row("a")]), root, "bronze_encounters", [DAY])
    daily.bronze_to_silver(spark, root, DAY)
    assert lake.read_table(spark, root, "silver_rejects", SILVER_REJECTS).count() == 0


def test_stream_scores_each_newest_hour_once(spark, root, tmp_path):
    class Same:
        def transform(self, df):
            return df.withColumn("predicted_arrivals_h1", df["arrivals_count"].cast("double")).withColumn("x", df["dt"])

    class Other(Same):
        def __init__(self, h):
            self.h = h

        def transform(self, df):
            return df.withColumn(f"predicted_arrivals_h{self.h}", df["arrivals_count"] * 1.0).withColumn("x", df["dt"])

    src = str(tmp_path / "features")

    def arrive(n, *given):
        data = [(when, count, None, 1.0, 0, None, None, None, when.date(), sector) for when, sector, count in given]
        spark.createDataFrame(data, GOLD_FEATURES).write.parquet(f"{src}/part={n}")
        score_latest_stream(read_files(spark, f"{src}/part=*", GOLD_FEATURES), {1: Same(), 4: Other(4), 24: Other(24)},
                            "v1", root, f"{root}/_checkpoint")
        return rows(lake.read_table(spark, root, "gold_predictions"), "sector_id", "prediction_ts", "predicted_arrivals_h24")

    first = [("ER", t("09:00"), 2.0), ("OR", t("08:00"), 5.0)]
    assert arrive(0, (t("08:00"), "ER", 1), (t("09:00"), "ER", 2), (t("08:00"), "OR", 5)) == first
    assert arrive(1, (t("07:00"), "ER", 9), (t("08:00"), "OR", 5)) == first, "older and equal hours are not scored"
    assert arrive(2, (t("10:00"), "ER", 3)) == [first[0], ("ER", t("10:00"), 3.0), first[1]]
