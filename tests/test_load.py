"""The load kept day by day against a rebuild of everything."""

import datetime as dt
import random

import pytest
from helpers import encounters, events, rows, t
from pyspark.sql import functions as F

from wardflow.plans import daily
from wardflow.plans.silver import silver_waits
from wardflow.schemas import GOLD_FEATURES, GOLD_METRICS, SECTORS
from wardflow.sources import lake

D1, D2, D3, D4 = (dt.date(2024, 1, d) for d in (1, 2, 3, 4))
OPS = ("sector_id", "window_start", "arrivals_count", "wait_avg_60m", "queue_size", "occupied_beds", "risk_score")


@pytest.fixture
def sectors(spark):
    return spark.createDataFrame([("ER", "Ana", 3), ("OR", "Bo", 2)], SECTORS)


def put(spark, root, enc, evt, days):
    lake.overwrite_days(silver_waits(encounters(spark, enc), events(spark, evt)), root, "silver_waits", days)


def ops(spark, root):
    return rows(lake.read_table(spark, root, "gold_ops"), *OPS)


def rebuilt(spark, sectors, waits_of, tmp, days):
    """All days at once in a lake of its own."""
    lake.overwrite_days(lake.read_table(spark, waits_of, "silver_waits"), tmp, "silver_waits")
    daily.update_load(spark, tmp, sectors, days)
    return ops(spark, tmp)


def test_a_late_discharge_reaches_all_later_days(spark, root, sectors):
    put(spark, root, [("a", t("10:10"), "ER")], [("a", "care_start", t("11:00"))], [D1])
    daily.update_load(spark, root, sectors, [D1])
    put(spark, root, [("b", t("2024-01-02 09:00"), "ER")], [], [D2])
    daily.update_load(spark, root, sectors, [D2])
    at_end = lake.read_table(spark, root, "gold_ops").where("hour = 23")
    assert rows(at_end, "dt", "occupied_beds", "queue_size") == [(D1, 1, 0), (D2, 1, 1)]
    # Delivered later: a left on day 1, and c came then and was never treated.
    put(spark, root, [("a", t("10:10"), "ER"), ("c", t("12:30"), "ER")],
        [("a", "care_start", t("11:00")), ("a", "discharge", t("18:00"))], [D1])
    assert daily.update_load(spark, root, sectors, [D1]) == [D1, D2]
    at_end = lake.read_table(spark, root, "gold_ops").where("hour = 23")
    assert rows(at_end, "dt", "occupied_beds", "queue_size") == [(D1, 0, 1), (D2, 0, 2)]


def test_any_order_of_days_equals_a_rebuild(spark, root, sectors, tmp_path):
    rnd = random.Random(9)

    def day_of(day, n):
        enc, evt = [], []
        for i in range(n):
            name, arrive = f"{day}-{i}", dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=rnd.randrange(1440))
            enc.append((name, arrive, rnd.choice(["ER", "ER", "OR"] if day != D1 else ["ER"])))
            care = arrive + dt.timedelta(minutes=rnd.randrange(0, 900))
            if rnd.random() < .8:
                evt.append((name, "care_start", care))
                if rnd.random() < .7:
                    evt.append((name, "discharge", care + dt.timedelta(minutes=rnd.randrange(0, 4000))))
        return enc, evt

    # Day 3 is built before day 2 has come, day 1 and 2 are corrected, day 2 loses its sector OR.
    for step in (D1, D3, (D2, D4), D1, (D2, D3)):
        changed = step if isinstance(step, tuple) else (step,)
        for day in changed:
            put(spark, root, *day_of(day, rnd.randrange(5, 30)), [day])
        daily.update_load(spark, root, sectors, changed)
        have = {r.dt for r in lake.read_table(spark, root, "silver_waits").select("dt").distinct().collect()}
        assert ops(spark, root) == rebuilt(spark, sectors, root, str(tmp_path / f"all-{step}".replace(" ", "")), have)
    before = ops(spark, root)
    daily.update_load(spark, root, sectors, [D2])
    assert ops(spark, root) == before, "a repeated run changes nothing"


def test_older_days_are_not_read(spark, root, sectors):
    for i, day in enumerate((D1, D2, D3)):
        put(spark, root, [(f"e{i}", dt.datetime.combine(day, dt.time(8)), "ER")], [], [day])
        daily.update_load(spark, root, sectors, [day])
    # What day 1 has left is taken from the levels alone.
    gone = lake.read_table(spark, root, "load_changes").where(F.col("dt") == F.lit(D1)).where("false")
    gone.drop("dt").write.mode("overwrite").parquet(f"{lake.path_of(root, 'load_changes')}/dt={D1}")
    put(spark, root, [], [], [D1])
    assert daily.update_load(spark, root, sectors, [D3]) == [D3]
    last = lake.read_table(spark, root, "gold_ops").where((F.col("dt") == F.lit(D3)) & (F.col("hour") == 23))
    assert rows(last, "queue_size") == [(3,)]


def test_features_around_a_corrected_day_equal_a_rebuild(spark, root):
    rnd = random.Random(3)
    days = [D1 + dt.timedelta(days=i) for i in range(8)]

    def deliver(day, names):
        enc = [(f"{day}{i}", dt.datetime.combine(day, dt.time(rnd.randrange(24))), rnd.choice(names)) for i in range(12)]
        lake.overwrite_days(encounters(spark, enc), root, "silver_encounters", [day])
        daily.silver_to_gold(spark, root, day)
        daily.build_features(spark, root, day)

    for i, day in enumerate(days):
        deliver(day, ["ER"] if i in (2, 3, 4, 5) else ["ER", "OR"])
    deliver(days[3], ["ER", "OR"])   # OR appears in the middle of its gap
    deliver(days[7], ["ER"])         # and is gone from the last day
    metrics = lake.read_table(spark, root, "gold_metrics", GOLD_METRICS)
    whole = daily.features_of_days(metrics, days[0], days[-1])
    stored = lake.read_table(spark, root, "gold_features", GOLD_FEATURES)
    columns = ("sector_id", "window_start", "arrivals_count", "rolling_avg_arrivals_4h", "lag_arrivals_24h",
               "target_arrivals_h1", "target_arrivals_h24")
    key = ["sector_id", "window_start"]
    assert rows(stored, *columns, by=key) == rows(whole, *columns, by=key)
