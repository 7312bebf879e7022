import datetime as dt
import random

from helpers import START, metrics, rows
from pyspark.sql import functions as F

from wardflow.operators.features import FEATURES, features_filled, features_strict, time_true
from wardflow.operators.hourly import hourly_metrics_dense
from wardflow.plans.daily import features_of_days


def test_rows_are_not_hours(spark):
    sparse = metrics(spark, [i if i % 2 == 0 else None for i in range(60)])
    by_row = {r.window_start: r for r in features_filled(sparse).collect()}
    by_time = {r.window_start: r for r in time_true(sparse).collect()}
    at = START + dt.timedelta(hours=50)
    assert by_row[at].lag_arrivals_24h == 2  # 24 rows are 48 hours here
    assert by_time[at].lag_arrivals_24h == 26
    assert by_row[at].rolling_avg_arrivals_4h == (44 + 46 + 48 + 50) / 4
    assert by_time[at].rolling_avg_arrivals_4h == (48 + 50) / 2


def test_strict_drops_before_it_leads(spark):
    out = features_strict(metrics(spark, list(range(30)))).orderBy("window_start").collect()
    assert len(out) == 6
    assert [r.target_arrivals_h1 for r in out] == [25, 26, 27, 28, 29, None]
    assert all(r.target_arrivals_h24 is None for r in out)
    assert [r.lag_arrivals_24h for r in out] == list(range(6))


def test_filled_keeps_every_row(spark):
    out = features_filled(metrics(spark, list(range(30)))).orderBy("window_start").collect()
    assert len(out) == 30
    assert out[0].rolling_avg_arrivals_4h == 0 and out[2].rolling_avg_arrivals_4h == 1.0
    assert [r.lag_arrivals_24h for r in out[22:27]] == [0, 0, 0, 1, 2]
    assert out[0].target_arrivals_h24 == 24


def test_null_acuity_does_not_drop_a_dense_row(spark):
    dense = hourly_metrics_dense(metrics(spark, [1] * 25 + [None] + [1] * 4))
    assert dense.where("avg_triage_acuity IS NULL").count() == 1
    assert features_strict(dense).count() == 5
    assert features_strict(dense, FEATURES).count() == 6


def test_one_exchange_for_all_features(spark):
    plan = features_strict(metrics(spark, [1] * 30))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_days_equal_the_run_over_all_history(spark):
    rnd = random.Random(3)
    # Holes of more than a day, a sector that starts late and one that stops early.
    a = [rnd.choice([None, 1, 2, 5]) for _ in range(240)]
    a[60:110] = [None] * 50
    a[0] = a[239] = 3
    sparse = (metrics(spark, a, "A").unionByName(metrics(spark, [None] * 100 + [2, None, 4, 1] * 10, "B"))
              .unionByName(metrics(spark, [7] * 30, "C")))
    full = features_filled(hourly_metrics_dense(sparse))
    for day in range(10):
        d = (START + dt.timedelta(days=day)).date()
        part = features_of_days(sparse, d, d)
        want = full.where(F.col("dt") == F.lit(d)).select(*part.columns)
        assert rows(part, by=["sector_id", "window_start"]) == rows(want, by=["sector_id", "window_start"]), d
