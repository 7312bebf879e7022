"""Knowledge-base chunks and the check of incoming text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.texts import CHUNK_CHARS, chunks, is_missing


def kb_chunks(documents: DataFrame, width: int = CHUNK_CHARS) -> DataFrame:
    """`source, chunk_no, text`: each document cut into fixed-width pieces, numbered from 0."""
    return documents.select("source", F.posexplode(chunks("text", width)).alias("chunk_no", "text"))


def split_rejects(df: DataFrame, text: str = "text", blank_too: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows with text to work on, and rows without as rejects with status 400 and a reason."""
    missing = is_missing(text, blank_too)
    rejects = df.where(missing).withColumns(
        {"status_code": F.lit(400), "reason": F.lit("No text provided")})
    return df.where(~missing), rejects
