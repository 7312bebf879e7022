"""Time expressions. All of them keep the type of their input (zoned or not)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def hour_start(ts: Column | str) -> Column:
    """The full hour at or before `ts`."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c - F.make_dt_interval(mins=F.minute(c), secs=F.extract(F.lit("SECOND"), c))


def hour_ceil(ts: Column | str) -> Column:
    """The full hour at or after `ts`."""
    c = F.col(ts) if isinstance(ts, str) else ts
    floor = hour_start(c)
    return F.when(floor == c, floor).otherwise(floor + hours(1))


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def non_negative(c: Column) -> Column:
    """A duration, or null where the clock ran backwards."""
    return F.when(c >= 0, c)


def version_stamp(ts: Column | str) -> Column:
    """Minute-precision version name such as 202401150930."""
    return F.date_format(ts, "yyyyMMddHHmm")
