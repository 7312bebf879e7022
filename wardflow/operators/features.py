"""Rolling, lag and lead columns over hourly metrics (see hourly.py for why this fits)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEATURES = ("rolling_avg_arrivals_4h", "lag_arrivals_24h")
HORIZONS = (1, 4, 24)


def _by_sector() -> Window:
    return Window.partitionBy("sector_id").orderBy("window_start")


def rolling_mean(df: DataFrame, column: str = "arrivals_count", rows: int = 4,
                 out: str = "rolling_avg_arrivals_4h") -> DataFrame:
    """Mean of this and the `rows - 1` rows before it; fewer at the start."""
    frame = _by_sector().rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn(out, F.avg(column).over(frame))


def lagged(df: DataFrame, column: str = "arrivals_count", rows: Sequence[int] = (24,),
           default: int | None = None, prefix: str = "lag_arrivals_") -> DataFrame:
    """The value `n` rows back, as `<prefix><n>h`; `default` (or null) where there is none."""
    w = _by_sector()
    for n in rows:
        back = F.lag(column, n).over(w)
        df = df.withColumn(f"{prefix}{n}h", back if default is None
                           else F.coalesce(back, F.lit(default).cast(df.schema[column].dataType)))
    return df


def targets(df: DataFrame, column: str = "arrivals_count",
            horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """The value `h` rows ahead as `target_arrivals_h<h>`; null at the end of a sector."""
    w = _by_sector()
    for h in horizons:
        df = df.withColumn(f"target_arrivals_h{h}", F.lead(column, h).over(w))
    return df


def features_strict(metrics: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Features, then rows with a null dropped, then targets over the rows that are left.

    The order matters: a target is the next surviving row. Without `subset` any null column
    drops the row; on dense metrics pass the feature names, since empty hours have no acuity.
    """
    built = lagged(rolling_mean(metrics))
    return targets(built.na.drop(subset=list(subset) if subset else None))


def features_filled(metrics: DataFrame) -> DataFrame:
    """Features with a missing lag as 0 and every row kept, then targets."""
    return targets(lagged(rolling_mean(metrics), default=0))


def time_true(metrics: DataFrame) -> DataFrame:
    """Rolling mean over 3 hours back and the value exactly 24 hours back, by clock.

    Right on sparse metrics too, where row counts are not hours.
    """
    frame = "OVER (PARTITION BY sector_id ORDER BY window_start RANGE BETWEEN {})"
    trailing = frame.format("INTERVAL 3 HOURS PRECEDING AND CURRENT ROW")
    day_back = frame.format("INTERVAL 24 HOURS PRECEDING AND INTERVAL 24 HOURS PRECEDING")
    return metrics.withColumns({
        "rolling_avg_arrivals_4h": F.expr(f"avg(arrivals_count) {trailing}"),
        "lag_arrivals_24h": F.expr(f"max(arrivals_count) {day_back}"),
    })
