import datetime as dt

import pytest
from helpers import bronze, encounters, events, rows, t

from wardflow.operators.dedup import keep_first, latest_per_group
from wardflow.operators.timeline import encounter_timeline, encounter_waits, orphan_events, with_sector
from wardflow.plans.silver import silver_encounters
from wardflow.schemas import SECTORS, SchemaMismatch, SILVER_ENCOUNTERS, conform

DAY = dt.date(2024, 1, 1)


def waits(spark, enc, evt):
    return encounter_waits(encounter_timeline(encounters(spark, enc), events(spark, evt))).first()


def test_earliest_of_a_repeated_id_stays(spark):
    df = encounters(spark, [("a", t("09:00"), "ER"), ("a", t("08:00"), "ER"), ("b", t("07:00"), "ER")])
    assert rows(keep_first(df, ["encounter_id"], ["arrival_time"]), "encounter_id", "arrival_time") == [
        ("a", t("08:00")), ("b", t("07:00"))]


def test_equal_times_are_settled_by_the_other_columns(spark):
    df = encounters(spark, [("a", t("08:00"), "ER", 4), ("a", t("08:00"), "ER", 2)])
    for order in (df, df.orderBy("triage_level"), df.repartition(3, "triage_level")):
        assert rows(keep_first(order, ["encounter_id"], ["arrival_time"]), "triage_level") == [(2,)]


def test_null_ids_count_as_one_key(spark):
    df = encounters(spark, [(None, t("08:00"), "ER"), (None, t("09:00"), "ER"), ("a", t("08:00"), "ER")])
    assert keep_first(df, ["encounter_id"], ["arrival_time"]).count() == 2


def test_a_hot_id_is_cut_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS at")
    kept = keep_first(df, ["k"], ["at"])
    assert kept.count() == df.select("k").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, "one limit on either side of the exchange"


def test_latest_row_per_group(spark):
    df = encounters(spark, [("a", t("08:00"), "ER"), ("b", t("09:00"), "ER"), ("c", t("07:00"), "OR")])
    assert rows(latest_per_group(df, ["sector_id"], "arrival_time"), "encounter_id") == [("b",), ("c",)]


def test_bad_text_becomes_null_not_an_error(spark):
    df = bronze(spark, [("a", "2024-01-01 08:00:00", "ER", "2", DAY), ("b", "tomorrow", "ER", "x", DAY)])
    assert rows(silver_encounters(df), "encounter_id", "arrival_time", "triage_level") == [
        ("a", t("08:00"), 2), ("b", None, None)]


def test_typed_bronze_is_accepted_too(spark):
    df = encounters(spark, [("a", t("08:00"), "ER")])
    assert rows(silver_encounters(df), "arrival_time") == [(t("08:00"),)]


def test_schema_check_names_what_is_wrong(spark):
    with pytest.raises(SchemaMismatch, match="triage_level: want int, have nothing"):
        conform(encounters(spark, []).drop("triage_level"), SILVER_ENCOUNTERS)
    with pytest.raises(SchemaMismatch, match="triage_level: want int, have string"):
        conform(encounters(spark, []).selectExpr(
            "* EXCEPT (triage_level)", "CAST(triage_level AS STRING) AS triage_level"), SILVER_ENCOUNTERS)


def test_zoned_times_are_taken_as_utc(spark):
    df = encounters(spark, [("a", t("08:00"), "ER")])
    zoned = df.withColumn("arrival_time", df.arrival_time.cast("timestamp"))
    assert rows(conform(zoned, SILVER_ENCOUNTERS), "arrival_time") == [(t("08:00"),)]


def test_full_timeline(spark):
    r = waits(spark, [("a", t("08:00"), "ER")], [
        ("a", "triage_start", t("08:10")), ("a", "triage_end", t("08:20")), ("a", "care_start", t("08:50")),
        ("a", "discharge", t("10:00")), ("a", "triage_start", t("09:00"))])
    assert (r.wait_triage_min, r.wait_service_min, r.total_wait_min, r.los_min) == (10, 30, 50, 120)
    assert r.negative_durations == 0


def test_open_stay_has_no_length(spark):
    r = waits(spark, [("a", t("08:00"), "ER")], [("a", "care_start", t("08:30"))])
    assert r.los_min is None and r.discharge_time is None


def test_skipped_triage_waits_from_arrival(spark):
    r = waits(spark, [("a", t("08:00"), "ER")], [("a", "care_start", t("08:30"))])
    assert r.wait_service_min == 30 and r.wait_triage_min is None


def test_past_midnight_is_one_encounter(spark):
    r = waits(spark, [("a", t("23:50"), "ER")], [("a", "care_start", t("2024-01-02 00:20"))])
    assert r.total_wait_min == 30 and r.dt == DAY


def test_negative_durations_are_null_and_counted(spark):
    r = waits(spark, [("a", t("08:00"), "ER")], [
        ("a", "triage_end", t("08:30")), ("a", "care_start", t("08:10")), ("a", "discharge", t("07:00"))])
    assert r.wait_service_min is None and r.los_min is None and r.total_wait_min == 10
    assert r.negative_durations == 2


def test_encounter_without_events_is_kept(spark):
    r = waits(spark, [("a", t("08:00"), "ER")], [("z", "care_start", t("08:10"))])
    assert r.encounter_id == "a" and r.care_start is None


def test_orphans(spark):
    evt = events(spark, [("a", "care_start", t("08:10")), ("z", "care_start", t("08:20"))])
    assert rows(orphan_events(evt, encounters(spark, [("a", t("08:00"), "ER")])), "encounter_id") == [("z",)]


def test_unknown_sector_keeps_the_fact(spark):
    dim = spark.createDataFrame([("ER", "Ana", 4)], SECTORS)
    out = with_sector(encounters(spark, [("a", t("08:00"), "ER"), ("b", t("08:00"), "OR")]), dim)
    assert rows(out, "encounter_id", "manager") == [("a", "Ana"), ("b", None)]
