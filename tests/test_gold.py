import datetime as dt
import random

from helpers import encounters, events, metrics, rows, t
from pyspark.sql import functions as F

from wardflow.functions.numbers import risk_score
from wardflow.operators.hourly import fill_hours, hourly_metrics_dense, hourly_metrics_sparse
from wardflow.operators.load import hourly_load, occupancy_hourly, ops_metrics_hourly, wait_avg_hourly
from wardflow.operators.status import current_status, forecast_today, predictions_preview
from wardflow.operators.timeline import encounter_timeline, encounter_waits
from wardflow.schemas import PREDICTIONS, SECTORS


def test_an_empty_hour_is_absent_or_zero(spark):
    enc = encounters(spark, [("a", t("08:10"), "ER", 2), ("b", t("10:05"), "ER", 4)])
    sparse = hourly_metrics_sparse(enc)
    assert rows(sparse, "window_start", "arrivals_count", "avg_triage_acuity") == [
        (t("08:00"), 1, 2.0), (t("10:00"), 1, 4.0)]
    assert rows(hourly_metrics_dense(sparse), "window_start", "arrivals_count", "avg_triage_acuity") == [
        (t("08:00"), 1, 2.0), (t("09:00"), 0, None), (t("10:00"), 1, 4.0)]


def test_count_skips_null_ids_and_mean_skips_null_levels(spark):
    enc = encounters(spark, [(None, t("08:10"), "ER", 2), ("b", t("08:20"), "ER", None), ("c", t("08:30"), "ER", 4)])
    assert rows(hourly_metrics_sparse(enc), "arrivals_count", "avg_triage_acuity") == [(2, 3.0)]


def test_counts_are_long(spark):
    schema = hourly_metrics_sparse(encounters(spark, [])).schema
    assert schema["arrivals_count"].dataType.simpleString() == "bigint"


def test_sectors_are_filled_on_their_own(spark):
    df = metrics(spark, [1, None, 2], "A").unionByName(metrics(spark, [5], "B"))
    assert rows(hourly_metrics_dense(df), "sector_id", "arrivals_count", by=["sector_id", "window_start"]) == [
        ("A", 1), ("A", 0), ("A", 2), ("B", 5)]


def test_dense_keeps_every_arrival(spark):
    rnd = random.Random(5)
    counts = [rnd.choice([None, None, 1, 4]) for _ in range(300)]
    counts[0] = counts[-1] = 1
    dense = hourly_metrics_dense(metrics(spark, counts))
    assert dense.count() == 300
    assert dense.agg(F.sum("arrivals_count")).first()[0] == sum(c or 0 for c in counts)


def test_carried_columns(spark):
    df = metrics(spark, [1, None, 2])
    assert rows(fill_hours(df, carry=["arrivals_count"]), "arrivals_count", by="window_start") == [(1,), (1,), (2,)]


def stays(spark, enc, evt):
    return encounter_waits(encounter_timeline(encounters(spark, enc), events(spark, evt)))


def test_beds_and_queue_by_hour(spark):
    df = stays(spark, [("a", t("08:10"), "ER"), ("b", t("08:30"), "ER")], [
        ("a", "care_start", t("09:15")), ("a", "discharge", t("11:00")),
        ("b", "care_start", t("10:00")), ("b", "discharge", t("10:30"))])
    assert rows(hourly_load(df), "window_start", "arrivals_count", "queue_size", "occupied_beds") == [
        (t("08:00"), 2, 2, 0),
        (t("09:00"), 0, 1, 1),
        (t("10:00"), 0, 0, 2),
        (t("11:00"), 0, 0, 0)]  # a left at 11:00 sharp


def test_open_stay_occupies_to_the_end_of_its_day(spark):
    df = stays(spark, [("a", t("22:10"), "ER")], [("a", "care_start", t("22:20"))])
    assert rows(hourly_load(df), "window_start", "occupied_beds") == [
        (t("22:00"), 1), (t("23:00"), 1), (t("2024-01-02 00:00"), 0)]
    later = hourly_load(df, F.lit("2024-01-02 01:30:00").cast("timestamp_ntz"))
    assert [r[1] for r in rows(later, "window_start", "occupied_beds")] == [1, 1, 1, 1, 0]


def test_never_treated_leaves_the_queue_with_the_day(spark):
    df = stays(spark, [("a", t("22:10"), "ER")], [])
    assert rows(hourly_load(df), "window_start", "queue_size", "occupied_beds") == [
        (t("22:00"), 1, 0), (t("23:00"), 1, 0), (t("2024-01-02 00:00"), 0, 0)]


def test_levels_equal_a_count_by_hand(spark):
    rnd, enc, evt, truth = random.Random(11), [], [], []
    for i in range(200):
        arrive = t("00:00") + dt.timedelta(minutes=rnd.randrange(0, 1200))
        care = arrive + dt.timedelta(minutes=rnd.randrange(0, 90)) if rnd.random() < 0.8 else None
        leave = care + dt.timedelta(minutes=rnd.randrange(0, 600)) if care and rnd.random() < 0.7 else None
        sector = rnd.choice(["A", "A", "B"])
        enc.append((f"x{i}", arrive, sector))
        if care:
            evt.append((f"x{i}", "care_start", care))
        if leave:
            evt.append((f"x{i}", "discharge", leave))
        midnight = t("2024-01-02 00:00")
        truth.append((sector, arrive, care, care or midnight, leave or (midnight if care else None)))
    hour = dt.timedelta(hours=1)
    for r in hourly_load(stays(spark, enc, evt)).collect():
        mine = [x for x in truth if x[0] == r.sector_id]
        h = r.window_start
        assert r.queue_size == sum(a < h + hour <= out for _, a, _, out, _ in mine)
        assert r.occupied_beds == sum(c is not None and c < h + hour and end > h for _, _, c, _, end in mine)


def test_occupancy_needs_a_capacity(spark):
    df = hourly_load(stays(spark, [("a", t("08:10"), "ER"), ("b", t("08:10"), "OR")],
                           [("a", "care_start", t("08:20")), ("b", "care_start", t("08:20"))]))
    dim = spark.createDataFrame([("ER", "Ana", 4), ("OR", "Bo", 0)], SECTORS)
    first = occupancy_hourly(df, dim).where("window_start = TIMESTAMP_NTZ '2024-01-01 08:00:00'")
    assert rows(first, "sector_id", "occupancy_rate") == [("ER", 0.25), ("OR", None)]


def test_documented_hourly_table(spark):
    df = hourly_load(stays(spark, [("a", t("08:10"), "ER")], [("a", "care_start", t("08:40"))]))
    out = ops_metrics_hourly(df, spark.createDataFrame([("ER", "Ana", 2)], SECTORS)).orderBy("window_start").first()
    assert (out.hour, out.arrivals_count, out.wait_avg_60m, out.occupancy_rate) == (8, 1, 30.0, 0.5)
    assert out.risk_score == 60 * 0.5 + 40 * 0.5


def test_risk_is_bounded_and_treats_unknown_as_none(spark):
    df = spark.createDataFrame([(3.0, 500.0), (None, None), (0.0, 30.0)], "o double, w double")
    assert sorted(r[0] for r in df.select(risk_score(F.col("o"), F.col("w"))).collect()) == [0.0, 20.0, 100.0]


def test_mean_wait_by_hour(spark):
    df = stays(spark, [("a", t("08:10"), "ER"), ("b", t("08:20"), "ER"), ("c", t("08:30"), "ER")],
               [("a", "care_start", t("08:20")), ("b", "care_start", t("08:50"))])
    assert rows(wait_avg_hourly(df), "window_start", "wait_avg_60m", "waits_count") == [(t("08:00"), 20.0, 2)]


def test_status_of_the_last_two_hours(spark):
    df = metrics(spark, [1, 2, 3, 4], start=t("07:00"))
    assert rows(current_status(df, F.lit(t("10:30")).cast("timestamp_ntz")), "window_start") == [
        (t("09:00"),), (t("10:00"),)]


def test_forecast_of_the_day(spark):
    df = spark.createDataFrame([
        ("ER", t("10:00"), "v", 1.005, 2.0, 3.0, t("10:00").date()),
        ("ER", t("2024-01-02 10:00"), "v", 2.345, 2.0, 3.0, t("2024-01-02 10:00").date())], PREDICTIONS)
    today = forecast_today(df, F.lit(t("2024-01-02 23:00")).cast("timestamp_ntz"))
    assert rows(today) == [("ER", 2.345, t("2024-01-02 10:00").date())]
    shown = rows(predictions_preview(df), "prediction_ts", "predicted_arrivals_h24")
    assert shown[0] == ("2024-01-01 10:00:00", 3.0)
