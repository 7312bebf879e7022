"""Small inputs for tests."""

import datetime as dt

from wardflow.schemas import BRONZE_ENCOUNTERS, GOLD_METRICS, SILVER_ENCOUNTERS, SILVER_EVENTS

START = dt.datetime(2024, 1, 1)


def t(text):
    return dt.datetime.fromisoformat(text if " " in text else f"2024-01-01 {text}")


def encounters(spark, rows):
    """Rows of (encounter_id, arrival, sector[, triage_level])."""
    data = [(r[0], r[1], "p", r[3] if len(r) > 3 else 3, r[1].date(), r[2]) for r in rows]
    return spark.createDataFrame(data, SILVER_ENCOUNTERS)


def events(spark, rows):
    """Rows of (encounter_id, event_type, time[, filed under day])."""
    data = [(f"e{i}", r[0], r[1], r[2], r[3] if len(r) > 3 else r[2].date()) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SILVER_EVENTS)


def metrics(spark, counts, sector="Emergency", start=START, acuity=3.0):
    """Hourly rows from `start`; None leaves the hour out."""
    data = []
    for i, n in enumerate(counts):
        if n is not None:
            at = start + dt.timedelta(hours=i)
            data.append((at, n, acuity, at.date(), sector))
    return spark.createDataFrame(data, GOLD_METRICS)


def bronze(spark, rows):
    """Rows of (encounter_id, arrival text, sector, triage text, day)."""
    return spark.createDataFrame([(r[0], r[1], "p", r[2], r[3], r[4]) for r in rows], BRONZE_ENCOUNTERS)


def rows(df, *columns, by=None):
    """Tuples of the chosen columns, in the order of `by` or of the columns themselves."""
    chosen = columns or df.columns
    order = [by] if isinstance(by, str) else by or list(chosen)
    return [tuple(r) for r in df.orderBy(*order).select(*chosen).collect()]
