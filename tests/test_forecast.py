import datetime as dt
import math
import random

import pytest
from helpers import START, metrics, rows
from pyspark.sql import functions as F

from wardflow.operators import forecast
from wardflow.operators.evaluation import drift_psi
from wardflow.operators.features import features_filled
from wardflow.operators.hourly import hourly_metrics_dense
from wardflow.plans import daily
from wardflow.schemas import GOLD_FEATURES, PREDICTIONS, conform
from wardflow.sources import lake, models
from wardflow.streaming import files
from wardflow.streaming.score import score_stream

DAYS = 21
SMALL = {"max_iter": 5, "max_depth": 3}


@pytest.fixture(scope="module")
def features(spark):
    """Two sectors with a daily rhythm and noise."""
    rnd = random.Random(4)
    day = [round(6 + 5 * math.sin((h - 6) / 24 * 2 * math.pi)) for h in range(24)]
    a = [max(0, day[h % 24] + rnd.choice([-3, -1, 0, 1, 3])) for h in range(24 * DAYS)]
    b = [max(0, 2 * day[h % 24] + rnd.choice([-4, 0, 4])) for h in range(24 * DAYS)]
    sparse = metrics(spark, a, "A").unionByName(metrics(spark, b, "B"))
    return conform(features_filled(hourly_metrics_dense(sparse)), GOLD_FEATURES).cache()


CUTOFF = START + dt.timedelta(days=DAYS - 7)


def test_split_has_no_future_in_training(features):
    past, held = forecast.split_by_time(features, F.lit(CUTOFF).cast("timestamp_ntz"))
    assert past.agg(F.max("window_start")).first()[0] < CUTOFF <= held.agg(F.min("window_start")).first()[0]
    assert past.count() + held.count() == features.count()


def test_model_beats_yesterday_on_held_out_hours(features):
    past, held = forecast.split_by_time(features, F.lit(CUTOFF).cast("timestamp_ntz"))
    errors = forecast.held_out_error(held, forecast.fit_horizons(past, (1, 24), **SMALL)).collect()
    assert [e.horizon for e in errors] == [1, 24]
    assert all(0 < e.mae <= e.rmse for e in errors)
    # The value 24 h before the target is not among the two features; the one 24 h before now is.
    lag = F.avg(F.abs(F.col("target_arrivals_h1") - F.col("lag_arrivals_24h")))
    assert errors[0].mae < held.agg(lag).first()[0]


def test_labels_of_held_out_hours_are_not_learned(features):
    origin = F.lit(CUTOFF).cast("timestamp_ntz")
    for h in (1, 4, 24):
        last = forecast.known_before(features, origin, h).agg(F.max("window_start")).first()[0]
        assert last + dt.timedelta(hours=h) == CUTOFF - dt.timedelta(hours=1)


def test_bar_is_the_value_a_day_before_the_target(features):
    counts = {(r.sector_id, r.window_start): r.arrivals_count for r in features.collect()}
    origins, hour = forecast.origins_before(CUTOFF + dt.timedelta(days=7), 3, 2) + [START], dt.timedelta(hours=1)
    out = {(r.origin, r.horizon): r for r in forecast.held_out_naive(features, origins, 4).collect()}
    assert len(out) == 9
    for (origin, h), r in out.items():
        misses = [abs(counts[s, at + h * hour] - counts[s, at + (h - 24) * hour]) for s, at in counts
                  if origin <= at < origin + 96 * hour and (s, at + h * hour) in counts and (s, at + (h - 24) * hour) in counts]
        assert r.pairs == len(misses) and r.naive_mae == pytest.approx(sum(misses) / len(misses))


def test_errors_over_several_origins(features):
    origins = forecast.origins_before(CUTOFF + dt.timedelta(days=7), 4, 2)
    errors, fitted = forecast.rolling_errors(features, origins, 4, (1,), **SMALL)
    parts = errors.collect()
    assert list(fitted) == [1] and [r.origin for r in parts] == origins
    for r, origin in zip(parts, origins):
        model = forecast.fit_horizons(features, (1,), F.lit(origin).cast("timestamp_ntz"), **SMALL)
        scored = forecast.predict(forecast.of_origin(forecast.with_naive(features), origin, 4), model).dropna(
            subset=["target_arrivals_h1", "naive_arrivals_h1"]).collect()
        assert r.pairs == len(scored)
        assert r.mae == pytest.approx(sum(abs(s.target_arrivals_h1 - s.predicted_arrivals_h1) for s in scored) / len(scored))
    both = forecast.over_origins(errors).first()
    a, b = parts
    assert (both.origins, both.pairs) == (2, a.pairs + b.pairs)
    assert both.mae == pytest.approx((a.mae * a.pairs + b.mae * b.pairs) / both.pairs)
    assert both.mae_sd == pytest.approx(abs(a.mae - b.mae) / math.sqrt(2))


def test_same_seed_same_forecast(features):
    fits = [forecast.predict(features, {1: forecast.fit_horizon(features, 1, **SMALL)}) for _ in range(2)]
    key = ["sector_id", "window_start"]
    assert rows(fits[0], *key, "predicted_arrivals_h1") == rows(fits[1], *key, "predicted_arrivals_h1")


def test_score_takes_the_last_closed_hour(features, spark):
    as_of, closed = dt.datetime(2024, 1, 10, 9, 20), dt.datetime(2024, 1, 10, 8)
    fitted = forecast.fit_horizons(features, **SMALL)
    out = conform(forecast.score_latest(features, fitted, F.lit(as_of).cast("timestamp_ntz"), "v1"), PREDICTIONS)
    assert rows(out, "sector_id", "prediction_ts", "model_version", "dt") == [
        ("A", closed, "v1", as_of.date()), ("B", closed, "v1", as_of.date())]
    at_eight = features.where(F.col("window_start") == F.lit(closed).cast("timestamp_ntz"))
    want = forecast.predict(at_eight, fitted)
    for h in (1, 4, 24):
        assert rows(out, "sector_id", f"predicted_arrivals_h{h}") == rows(want, "sector_id", f"predicted_arrivals_h{h}")


def test_naive_forecast(spark):
    f = features_filled(metrics(spark, list(range(30))))
    out = {r.prediction_ts: r for r in forecast.naive_predictions(f).collect()}
    r = out[START + dt.timedelta(hours=26, minutes=59)]
    assert (r.predicted_arrivals_h1, r.predicted_arrivals_h4, r.predicted_arrivals_h24) == (24.5, 13.25, 26.0)
    assert r.model_version == "naive-202401020000"


def test_train_register_load_score(spark, features, root):
    with pytest.raises(lake.EmptyInput):
        models.load_latest(spark, root)
    lake.overwrite_days(features, root, "gold_features")
    end = dt.datetime.combine(START.date() + dt.timedelta(days=DAYS - 1), dt.time(12))
    first = daily.train(spark, root, end - dt.timedelta(days=1), **SMALL)
    second = daily.train(spark, root, end, **SMALL)
    assert (first, second) == ("202401201200", "202401211200")
    version, fitted = models.load_latest(spark, root)
    assert version == second and list(fitted) == [1, 4, 24]
    listed = models.registry(spark, root)
    assert listed.count() == 6
    assert listed.where("beats_naive != (mae <= naive_mae)").count() == 0
    assert listed.where("origins = 1 AND mae_sd IS NULL").count() == 6
    for minute in (0, 15):
        daily.score(spark, root, end + dt.timedelta(minutes=minute))
    stored = lake.read_table(spark, root, "gold_predictions")
    assert rows(stored, "sector_id", "run_ts") == [
        (s, f"2024012112{m:02d}") for s in "AB" for m in (0, 15)]
    # Drift reads what was sketched as rows were written; a score that is run again counts once.
    daily.score(spark, root, end)
    daily.sketch_days(spark, root, [START.date() + dt.timedelta(days=i) for i in range(DAYS)])
    sketched = lake.read_table(spark, root, "gold_sketches")
    assert sketched.where("feature = 'predicted_arrivals_h4'").agg(F.sum("row_count")).first()[0] == 4
    day = START.date() + dt.timedelta(days=DAYS - 3)
    out = {r.feature: r for r in daily.drift(spark, root, day, day + dt.timedelta(days=2)).collect()}
    assert (out["arrivals_count"].baseline_rows, out["arrivals_count"].current_rows) == (2 * 24 * (DAYS - 3), 2 * 24 * 3)
    assert out["arrivals_count"].psi == pytest.approx(drift_psi(
        features.where(F.col("dt") < day), features.where(F.col("dt") >= day), ["arrivals_count"]).first().psi)


def test_streamed_scores_equal_the_batch(spark, features, root, tmp_path):
    lake.overwrite_days(features, root, "gold_features")
    fitted = {1: forecast.fit_horizon(features, 1, **SMALL)}
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = files.read_files(spark, lake.path_of(root, "gold_features"), GOLD_FEATURES, files_per_batch=20)
        score_stream(stream, fitted, "v1", out, check)
    run()
    run()  # nothing new: nothing twice
    want = forecast.predict(features, fitted)
    key = ["sector_id", "window_start", "predicted_arrivals_h1"]
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() > 1
    assert rows(got, *key) == rows(want, *key)
