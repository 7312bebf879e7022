import datetime as dt
import math
import random

import pytest
from helpers import START, encounters, metrics, rows, t
from pyspark.sql import functions as F

from wardflow.operators import quality
from wardflow.operators.asof import asof_join
from wardflow.operators.sketches import column_sketches, drift_of_sketches
from wardflow.operators.evaluation import drift_psi, forecast_error, predicted_vs_actual, predictions_long
from wardflow.schemas import PREDICTIONS
from wardflow.sources.lake import stored

D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))


def ntz(x):
    return F.lit(x).cast("timestamp_ntz")


def test_a_day_without_rows_fails(spark):
    df = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("2024-01-03 08:00"), "ER")])
    assert rows(quality.existence(df, quality.expected_days(df))) == [
        (D1, 1, "PASSED"), (D2, 0, "FAILED"), (D3, 1, "PASSED")]


def test_null_share_per_column(spark):
    df = encounters(spark, [("a", t("08:00"), "ER", None), ("b", t("09:00"), "ER", 2)])
    out = quality.null_counts(df, ["encounter_id", "triage_level"], 0.4)
    assert rows(out, "column_name", "null_count", "null_rate", "status") == [
        ("encounter_id", 0, 0.0, "PASSED"), ("triage_level", 1, 0.5, "FAILED")]


def test_null_share_of_nothing(spark):
    assert rows(quality.null_counts(encounters(spark, []), ["dt"]), "null_rate", "status") == [(None, "PASSED")]


def test_times_out_of_range(spark):
    df = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("08:01"), "ER"), ("c", t("2024-01-02 08:00"), "ER")])
    assert rows(quality.timestamp_range(df, "arrival_time", ntz(t("08:01")), ntz(t("2024-01-02 08:00"))),
                "dt", "row_count", "out_of_range", "status") == [(D1, 2, 1, "FAILED"), (D2, 1, 0, "PASSED")]


def test_report_names_the_first_broken_rule(spark):
    df = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("2024-01-02 08:00"), "ER", None),
                            ("c", t("2024-01-04 08:00"), "ER")])
    out = quality.report(df, quality.expected_days(df), ["encounter_id", "triage_level"], "arrival_time",
                         ntz(START), ntz(t("2024-01-03 00:00")))
    assert [(r.status, r.reason, r.checks) for r in out.orderBy("dt").collect()] == [
        ("PASSED", None, ["existence", "nulls", "time_range"]),
        ("FAILED", "too many nulls: triage_level", ["existence", "time_range"]),
        ("FAILED", "no rows", []),
        ("FAILED", "time out of range", ["existence", "nulls"])]
    with pytest.raises(quality.QualityGateFailed, match="2024-01-02: too many nulls"):
        quality.require_passed(out)
    quality.require_passed(out.where("status = 'PASSED'"))


def test_null_limit_holds_for_each_column(spark):
    df = encounters(spark, [(str(i), t("08:00"), "ER", None if i < 2 else 3) for i in range(10)])
    out = quality.report(df, quality.expected_days(df), ["encounter_id", "arrival_time", "triage_level"], "arrival_time",
                         ntz(START), ntz(t("2024-01-03 00:00")), 0.1).first()
    assert (out.status, out.reason, out.null_count) == ("FAILED", "too many nulls: triage_level", 2)


def predictions(spark, data):
    return spark.createDataFrame([(s, at, "v", a, b, c, at.date()) for s, at, a, b, c in data], PREDICTIONS)


def test_horizons_as_rows(spark):
    out = predictions_long(predictions(spark, [("ER", t("08:15"), 1.0, 2.0, 3.0)]))
    assert rows(out, "horizon_h", "horizon", "predicted_arrivals") == [(1, "+1h", 1.0), (4, "+4h", 2.0), (24, "+24h", 3.0)]


def test_prediction_meets_its_hour_and_zero_is_skipped(spark):
    actual = metrics(spark, [5, 4, 0, 8], "ER", start=t("08:00"))
    pairs = predicted_vs_actual(predictions(spark, [("ER", t("08:15"), 3.0, 1.0, 1.0), ("ER", t("09:15"), 1.0, 1.0, 1.0)]), actual)
    assert rows(pairs, "target_hour", "horizon", "predicted_arrivals", "actual_arrivals") == [
        (t("09:00"), "+1h", 3.0, 4), (t("10:00"), "+1h", 1.0, 0)]
    e = forecast_error(pairs).first()
    assert (e.pairs, e.skipped_zero, e.mae, e.mape) == (2, 1, 1.0, 0.25) and e.rmse == 1.0


def test_drift_against_a_formula_by_hand(spark):
    rnd = random.Random(1)
    base, now = [rnd.gauss(0, 1) for _ in range(400)], [rnd.gauss(0.7, 2) for _ in range(150)]
    lo, width = min(base), (max(base) - min(base)) / 10

    def shares(values):
        bins = [0] * 10
        for v in values:
            bins[min(9, max(0, math.floor((v - lo) / width)))] += 1
        return [max(b / len(values), 1e-6) for b in bins]

    want = sum((c - b) * math.log(c / b) for b, c in zip(shares(base), shares(now)))
    frames = [spark.createDataFrame([(v, 1.0) for v in x], "x double, flat double") for x in (base, now)]
    out = {r.feature: r for r in drift_psi(*frames, ["x", "flat"]).collect()}
    assert out["x"].psi == pytest.approx(want) and out["flat"].psi == 0
    assert (out["x"].baseline_rows, out["x"].current_rows) == (400, 150)
    same = drift_psi(frames[0], frames[0], ["x"]).first()
    assert same.psi == 0


def test_drift_from_sketches_of_days(spark):
    rnd = random.Random(2)
    few = [(d, float(rnd.randint(0, 9) + (d > 5)), 1.0, None) for d in range(8) for _ in range(150)]
    df = spark.createDataFrame(few, "d int, x double, flat double, none double")
    days = stored(column_sketches(df, ["x", "flat", "none"], ["d"]))
    assert days.count() == 16
    out = {r.feature: r for r in drift_of_sketches(days.where("d < 6"), days.where("d >= 6")).collect()}
    want = {r.feature: r for r in drift_psi(df.where("d < 6"), df.where("d >= 6"), ["x", "flat"]).collect()}
    assert set(out) == {"x", "flat"}
    for name, r in want.items():
        assert out[name].psi == pytest.approx(r.psi, abs=1e-9)
        assert (out[name].baseline_rows, out[name].current_rows) == (r.baseline_rows, r.current_rows) == (900, 300)


def test_drift_from_sketches_of_many_values(spark):
    base = spark.range(120_000).select((F.randn(5)).alias("x"), (F.col("id") % 30).alias("d"))
    now = spark.range(40_000).select((F.randn(6) * 1.5 + 0.4).alias("x"), (F.col("id") % 7).alias("d"))
    sketched = [stored(column_sketches(f, ["x"], ["d"])) for f in (base, now)]
    exact = drift_psi(base, now, ["x"]).first().psi
    assert exact > 0.1 and drift_of_sketches(*sketched).first().psi == pytest.approx(exact, abs=0.02)
    # A flat baseline that moved, and a current side without rows.
    flat = column_sketches(base.select(F.lit(1.0).alias("x")), ["x"])
    moved = column_sketches(base.select(F.lit(50.0).alias("x")), ["x"])
    assert drift_of_sketches(flat, moved).first().psi > 1 and drift_of_sketches(flat, flat).first().psi == 0
    gone = drift_of_sketches(flat, moved.limit(0)).first()
    assert gone.current_rows == 0 and gone.psi > 1


@pytest.mark.parametrize("settle", [lambda df: df, stored])
def test_latest_at_or_before_equals_a_search_by_hand(spark, settle):
    rnd = random.Random(9)
    right = [(rnd.choice("AB"), START + dt.timedelta(minutes=15 * rnd.randrange(0, 3000)), float(i)) for i in range(300)]
    right += [("A", right[0][1], 1000.0), ("A", START + dt.timedelta(hours=5), 2000.0)]
    left = [(i, rnd.choice("ABC"), START + dt.timedelta(minutes=rnd.randrange(-300, 60000))) for i in range(500)]
    # Exact hits, a hot key and hour, and a missing time.
    left += [(1000 + i, r[0], r[1]) for i, r in enumerate(right)]
    left += [(2000 + i, "A", START + dt.timedelta(hours=5)) for i in range(300)] + [(5000, "A", None)]
    got = asof_join(spark.createDataFrame(left, "id int, k string, at timestamp_ntz"),
                    spark.createDataFrame(right, "k string, made timestamp_ntz, v double"), "k", "at", "made", ["made", "v"], settle)
    out = {r.id: (r.made, r.v) for r in got.collect()}
    assert len(out) == len(left)
    for i, k, at in left:
        before = [(made, v) for key, made, v in right if key == k and at is not None and made <= at]
        assert out[i] == (max(before) if before else (None, None))


def test_asof_survives_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_latest_at_or_before_equals_a_search_by_hand(spark, lambda df: df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drift_of_a_flat_column_that_moved(spark):
    flat = spark.createDataFrame([(1.0,)] * 20, "x double")
    moved = spark.createDataFrame([(50.0,)] * 20, "x double")
    assert drift_psi(flat, moved, ["x"]).first().psi > 1
    assert drift_psi(flat, flat, ["x"]).first().psi == 0
