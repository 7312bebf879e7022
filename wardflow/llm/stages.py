"""Stages of the corpus pipeline: each applies one operator's decisions to documents.

All but the last return the columns of the documents they got. Rows are told apart by doc_id and
text; null texts count as empty, null doc_ids are kept apart by their texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, decontaminate, outliers, secrets, simhash
from wardflow.llm.common import stored
from wardflow.sources.given import table

MASK = "[secret]"


def _marked(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_keep_id", F.col("doc_id").cast("long")).withColumn(
        "_keep_th", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """`docs` without the rows of `rejected(_id, _th)`."""
    marked = _marked(docs)
    on = [marked["_keep_id"].eqNullSafe(rejected["_id"]), marked["_keep_th"] == rejected["_th"]]
    return marked.join(rejected, on, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return outliers.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stored(found.select("_id", "_th").distinct()))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; `n_chars` follows. Values that are copied widely, known
    examples, stay."""
    found = secrets.find_secrets(docs).where(F.col("n_live") > 0).select(
        F.col("doc_id").alias("_id"), "_th", "found").dropDuplicates(["_id", "_th"])
    marked = _marked(docs)
    known = stored(found)
    on = [marked["_keep_id"].eqNullSafe(known["_id"]), marked["_keep_th"] == known["_th"]]
    text = secrets.masked(F.col("text"), F.col("found"), MASK)
    done = marked.join(known, on, "left").withColumn(
        "text", F.when(F.col("found").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("found").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and hashes of each text's token ids and of the bytes they decode to."""
    return bpe.digests(bpe.encode_texts(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
