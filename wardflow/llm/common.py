"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import BATCH_BYTES, bounded_batches
from wardflow.sources.lake import stored

__all__ = ["BATCH_BYTES", "IDENTITY", "bounded_batches", "identified", "once", "ragged", "same_row", "stored"]

#: What tells rows of a table apart: rows equal in both are alike for every operator here.
IDENTITY = ("_id", "_th")


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id` and a hash of the text as identity, the text with null as empty, and `more`.

    Only these columns are taken, so further columns of any name do no harm.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_th"),
                       text.alias("text"), *[F.col(c) for c in more])


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Rows of the same identity; a null id equals a null id."""
    return a["_id"].eqNullSafe(b["_id"]) & a["_th"].eqNullSafe(b["_th"])


def once(key: tuple, make: Callable[[], Any]) -> Any:
    """`make()` once in each worker process: functions arrive anew with every task, and what they
    hold would be lost. Holds the newest object only."""
    held = sys.modules.setdefault("_wardflow_held", types.ModuleType("_wardflow_held")).__dict__
    if key not in held:
        for other in [k for k in held if isinstance(k, tuple)]:
            del held[other]
        held[key] = make()
    return held[key]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each range, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
