"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def coerce_number(c: Column | str) -> Column:
    """Text to double, null where the text is not a number.

    Spark's cast also takes a Java type letter ('12d', '3.5F'); that is not a number here.
    """
    c = F.col(c) if isinstance(c, str) else c
    typed_suffix = c.rlike(r"[0-9.]\s*[dDfF]\s*$")
    return F.when(~typed_suffix, c.try_cast("double"))


def round_numbers(df: DataFrame, places: int = 2) -> DataFrame:
    """Every floating column rounded half to even."""
    return df.select(*[
        F.bround(f.name, places).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema
    ])


def risk_score(occupancy_rate: Column, wait_min: Column, *,
               occupancy_weight: float = 60.0, wait_weight: float = 40.0,
               wait_full_min: float = 60.0) -> Column:
    """Overload risk from 0 to 100.

    The documents name the score and its range but no formula; the weights are ours. A
    missing rate or wait counts as no load.
    """
    occupied = F.lit(occupancy_weight) * F.coalesce(occupancy_rate, F.lit(0.0))
    waiting = F.lit(wait_weight) * F.least(
        F.lit(1.0), F.coalesce(wait_min, F.lit(0.0)) / F.lit(wait_full_min))
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), occupied + waiting))
