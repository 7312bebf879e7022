"""The corpus pipeline: quality rules, near-dedup, decontamination, secret masking, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardflow.llm import stages  # noqa: E402
from wardflow.session import run_dir  # noqa: E402
from wardflow.sources.given import table  # noqa: E402

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("secret_scan", stages.secret_scan),
    ("bpe_encoding", stages.bpe_encoding),
]

#: Fingerprints, edit distances and token ids have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
