"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`node, component` for each node of `links(u, v)`, two columns of longs: the component is
    its smallest node. Nodes without a link are not listed.

    Alternates large stars (larger neighbours move to the smallest one) and small stars (smaller
    neighbours do), until nothing changes: a logarithmic number of rounds in practice. Minima
    are taken before the shuffle, so a node with very many links does no harm there. Each round
    is written to the shared folder, so lost executors cost one round at most.
    """
    stars = stored(links.where(F.col("u") != F.col("v"))
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
