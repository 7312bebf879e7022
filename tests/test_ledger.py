import datetime as dt

import pytest
from helpers import bronze, rows

from wardflow.sources import lake, ledger
from wardflow.streaming.ingest import ingest_stream

ONE, TWO = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def deliver(spark, path, data):
    made = [(e, at, "ER", "3", ONE) for e, at in data]
    bronze(spark, made).drop("dt").coalesce(1).write.mode("append").parquet(path)


def stored(spark, root, *columns):
    return rows(lake.read_table(spark, root, "bronze_encounters"), *columns)


@pytest.fixture
def run(spark, root, tmp_path):
    src = str(tmp_path / "in")
    return src, lambda checkpoint="c": ingest_stream(spark, src, root, "encounters", str(tmp_path / checkpoint))[1]


def test_files_are_taken_once(spark, root, run):
    src, ingest = run
    deliver(spark, src, [("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 08:00:00"), ("b", "2024-01-02 09:00:00")])
    assert ingest() == [ONE, TWO]
    want = [("a", ONE), ("a", ONE), ("b", TWO)]
    assert stored(spark, root, "encounter_id", "dt") == want
    # Nothing new; a lost checkpoint; the same rows in another file.
    assert ingest() == [] and ingest("other") == []
    deliver(spark, src, [("b", "2024-01-02 09:00:00"), ("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 08:00:00")])
    assert ingest() == []
    assert stored(spark, root, "encounter_id", "dt") == want
    # A late row of an older day, and a time that cannot be read.
    deliver(spark, src, [("late", "2024-01-01 23:00:00"), ("odd", "soon")])
    days = ingest()
    assert days[0] == ONE and len(days) == 2 and TWO not in days
    assert stored(spark, root, "encounter_id") == [("a",), ("a",), ("b",), ("late",), ("odd",)]
    met = rows(ledger.ledger(spark, root), "status", "row_count", "late_rows")
    assert met == [("added", 2, 1), ("added", 3, 0)] + [("repeated", 3, 0)] * (len(met) - 2) and len(met) > 2


def test_a_run_that_failed_is_replaced(spark, root, run, monkeypatch):
    src, ingest = run
    deliver(spark, src, [("a", "2024-01-01 08:00:00")])
    real = lake.replace_run

    def fails(df, root, table, run_ts):
        if table == "ingest_ledger":
            raise OSError("lost")
        real(df, root, table, run_ts)
    monkeypatch.setattr(lake, "replace_run", fails)
    with pytest.raises(Exception, match="lost"):
        ingest()
    monkeypatch.undo()
    # The next run meets more files than the one that failed, so it is another run.
    deliver(spark, src, [("b", "2024-01-01 09:00:00")])
    files = ledger.delivered(spark.read.parquet(src), "encounters")
    assert ledger.take(files, root, "encounters") == [ONE]
    assert stored(spark, root, "encounter_id") == [("a",), ("b",)]
    assert ledger.take(files, root, "encounters") == []
    assert stored(spark, root, "encounter_id") == [("a",), ("b",)]


def test_bronze_from_before_the_ledger_stays(spark, root, run):
    src, ingest = run
    old = [("x", "2024-01-01 01:00:00", "ER", "3", ONE), ("y", "2024-01-02 01:00:00", "ER", "3", TWO)]
    lake.append(bronze(spark, old), root, "bronze_encounters")
    for e in "ab":
        deliver(spark, src, [(e, "2024-01-01 08:00:00")])
        ingest()
    assert stored(spark, root, "encounter_id", "dt") == [("a", ONE), ("b", ONE), ("x", ONE), ("y", TWO)]
