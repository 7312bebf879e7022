"""The corpus operators as named queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    alignment, bpe, chat, collocations, decontaminate, huffman, licenses, outliers, rules, secrets, sharding, simhash, suffix)
from wardflow.session import run_dir
from wardflow.sources.given import table

END_ID = 2  # ends each document


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("found", "_th")


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex(F.get("sig", 0)), 16, "0")).alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("_th").withColumnRenamed("_id", "doc_id")


def op4_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "shards")
    sharding.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    text = F.coalesce("text", F.lit(""))
    return sharding.read(spark, path).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op6_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op7_exact_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(*suffix.remove_repeats(table(spark, sf_dir, "documents")))


def op8_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token-files")
    huffman.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return huffman.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op10_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op11_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))[0]


def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


CHAT = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (
  SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(role || chr(1) || text, chr(2)) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
ends AS (
  SELECT position, md5(prefix) AS prefix, min(conv_id) AS conv_id, count(*) AS n_copies
  FROM numbered WHERE position = n_turns GROUP BY ALL),
kept AS (
  SELECT conv_id, n_copies FROM ends e WHERE NOT EXISTS (
    SELECT 1 FROM numbered n WHERE n.position < n.n_turns AND n.position = e.position AND md5(n.prefix) = e.prefix))
SELECT n.conv_id, n.position, n.n_turns, k.n_copies,
       '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS rendered
FROM numbered n JOIN kept k ON n.conv_id IS NOT DISTINCT FROM k.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_chat_snapshots": CHAT}
