"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_CHARS = 1000


def chunks(text: Column | str, width: int = CHUNK_CHARS) -> Column:
    """`text` cut every `width` characters; the last piece may be short, empty text gives none.

    One regular expression pass is linear in the length of the text. Taking substrings by
    position instead walks from the start for every piece, which is quadratic.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{int(width)}}}"), F.lit(0))


def is_missing(text: Column | str, blank_too: bool = False) -> Column:
    """True where there is nothing to work on: null or empty, or only blanks if `blank_too`."""
    c = F.col(text) if isinstance(text, str) else text
    return c.isNull() | ((F.trim(c) if blank_too else c) == "")
