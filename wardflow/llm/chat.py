"""Chat formatting: collapse of conversations that were logged again at each turn.

Each turn gets a hash of the conversation up to it. A conversation whose last hash is an inner
hash of a longer one is a snapshot of that one and goes; of equal conversations one stays.
The hash of a prefix combines the hashes of (position, role, text) by exclusive or, so it can be
summed in blocks of turns. Blocks are the pieces of a conversation in ranges of the whole table in
its order, which are of about equal size: one conversation may hold any share of all rows, also all
of them under one turn number or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import stored

BLOCK = 100_000  # rows of a range; no window partition has more but for the sampling of the ranges

KEYS = ["conv_id", "_b"]


def with_prefixes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """`conv_id, position, role, text, n_turns, h1, h2`: turns numbered from 1, with the two
    64-bit hashes of the conversation up to and with the turn.

    Rows equal in conv_id, turn, role and text count once. Turns are ordered by turn (null
    first), ties by role and text; null role and text count as empty; rows without conv_id form
    one conversation.
    """
    turns = (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct())
    ranges = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-conversations.count() // block))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    placed = stored(
        turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .select("conv_id", "role", "text", F.spark_partition_id().alias("_b"), F.monotonically_increasing_id().alias("_i")))
    sizes = placed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    by_conv = W.partitionBy("conv_id")
    so_far = by_conv.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*KEYS, (F.coalesce(F.sum("_n").over(so_far), F.lit(0)) - F.col("_first") + 1).alias("_off"),
                           F.sum("_n").over(by_conv).alias("n_turns"))
    numbered = stored(
        _with_block(placed, offsets)
        .withColumn("position", (F.col("_off") + F.col("_i")).cast("long"))
        .select(*KEYS, "position", "role", "text", "n_turns",
                F.xxhash64(F.lit(1), "position", "role", "text").alias("_e1"),
                F.xxhash64(F.lit(2), "position", "text", "role").alias("_e2")))
    totals = numbered.groupBy(*KEYS).agg(F.bit_xor("_e1").alias("_t1"), F.bit_xor("_e2").alias("_t2"))
    before = totals.select(*KEYS, *[
        F.coalesce(F.bit_xor(f"_t{k}").over(so_far), F.lit(0).cast("long")).alias(f"_o{k}") for k in (1, 2)])
    running = W.partitionBy(*KEYS).orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    up_to = numbered.select("*", *[F.bit_xor(f"_e{k}").over(running).alias(f"_r{k}") for k in (1, 2)])
    return _with_block(up_to, before).select(
        "conv_id", "position", "role", "text", "n_turns",
        *[F.col(f"_r{k}").bitwiseXOR(F.col(f"_o{k}")).alias(f"h{k}") for k in (1, 2)])


def _with_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    named = blocks.withColumnsRenamed({k: f"_k_{k}" for k in KEYS})
    return rows.join(named, [rows[k].eqNullSafe(named[f"_k_{k}"]) for k in KEYS]).drop(*[f"_k_{k}" for k in KEYS])


def maximal(prefixes: DataFrame) -> DataFrame:
    """`conv_id, n_copies` of the conversations that no longer one begins with; of equal ones
    the smallest conv_id, with their number. Hashes meet only after equal ones were merged."""
    same = ["position", "h1", "h2"]
    ends = (prefixes.where(F.col("position") == F.col("n_turns")).groupBy(*same)
            .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    inner = prefixes.where(F.col("position") < F.col("n_turns")).select(*same).distinct()
    return ends.join(inner, same, "left_anti").select("conv_id", "n_copies")


def render(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns of the maximal conversations, each as `<|role|>` line, text and end mark.

    One row per turn, so that no conversation has to fit one cell: `conv_id, position, n_turns,
    n_copies, rendered`; in order of position they are the conversation. An empty table gives no
    rows; other columns are not read.
    """
    prefixes = stored(with_prefixes(conversations, block))
    kept = maximal(prefixes).withColumnRenamed("conv_id", "_kept")
    return (
        prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")))
        .select("conv_id", "position", F.col("n_turns").cast("long").alias("n_turns"), "n_copies",
                F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("rendered")))
