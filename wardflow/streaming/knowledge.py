"""Knowledge-base chunks of documents as they arrive, are replaced, or go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow.functions.texts import CHUNK_CHARS
from wardflow.operators.dedup import latest_per_group
from wardflow.operators.encode import Encoder, embed, hashing_encoder
from wardflow.operators.texts import kb_chunks
from wardflow.schemas import KB_SOURCES, KB_STORED, conform
from wardflow.sources import lake
from wardflow.streaming.files import ANY_AGE

BUCKETS = 64


def document_files(spark: SparkSession, path: str) -> DataFrame:
    """`source, text` of new UTF-8 files under `path`, one row per file."""
    return (spark.readStream.option("maxFileAge", ANY_AGE).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))


def chunk_stream(documents: DataFrame, width: int = CHUNK_CHARS,
                 make_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """Chunks of a stream of documents, with vectors if an encoder is given. Keeps no state."""
    chunks = kb_chunks(documents, width)
    return embed(chunks, make_encoder) if make_encoder else chunks


def _bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64("source"), F.lit(n)).cast("int").alias("bucket")


def _buckets_of(df: DataFrame) -> list[int]:
    """The buckets that `df` has rows of: as many as there are buckets at most."""
    return sorted(r.bucket for r in df.select("bucket").distinct().collect())


def upsert_documents(versions: DataFrame, root: str, width: int = CHUNK_CHARS,
                     make_encoder: Callable[[], Encoder] = hashing_encoder, buckets: int = BUCKETS) -> None:
    """Puts versions of documents, `source, modified, text, deleted`, into the knowledge base.

    The newest version of a source wins, whatever order versions come in; of equal ones the last
    delivered. Its chunks take the place of all older ones. A deleted source loses its chunks
    and stays marked, so that an older version that comes late does not bring it back. Rows without
    a source are left out. Only the buckets of the sources that change are read and written; without
    news nothing is. Chunks that stay are copied from file to file, shuffled only when a bucket has
    many small files. Applying the same versions again changes nothing, so a batch can be repeated after a failure. `buckets`
    stays the same for the life of a knowledge base and grows with its planned size.
    """
    spark = versions.sparkSession
    fresh = versions.where(F.col("source").isNotNull()).select(
        "source", F.col("modified").cast("timestamp_ntz").alias("modified"), "text",
        F.coalesce("deleted", F.lit(False)).alias("deleted"), _bucket(buckets))
    known = lake.table_or_empty(spark, root, "kb_sources", KB_SOURCES)
    known = known.where(F.col("bucket").isin(_buckets_of(fresh)))
    before = known.select("source", F.col("modified").alias("_modified"))
    winners = lake.stored(latest_per_group(fresh, ["source"], "modified").join(before, "source", "left").where(
        F.col("_modified").isNull() | (F.col("modified") >= F.col("_modified"))).drop("_modified"))
    # A table without texts is small, and joins know that it is.
    names = lake.stored(winners.select(*KB_SOURCES.fieldNames(), (~F.col("deleted") & (F.length("text") > 0)).alias("_filled")))
    touched = _buckets_of(names)
    if not touched:
        return
    stored = lake.table_or_empty(spark, root, "kb_chunks", KB_STORED).where(F.col("bucket").isin(touched))
    others = stored.join(names.select("source"), "source", "left_anti")
    if lake.fragmented(stored, len(touched)):
        others = lake.rebalanced(others, ("bucket",))
    # Texts are dealt to buckets before they are cut and embedded: vectors are never shuffled.
    made = embed(kb_chunks(lake.rebalanced(winners.where(~F.col("deleted")), ("bucket",)), width), make_encoder).withColumn(
        "bucket", _bucket(buckets))
    left = others.select("bucket").unionByName(names.where("_filled").select("bucket"))
    # Sources last: until they are written, a repeated run finds the same winners.
    lake.replace_buckets(conform(others, KB_STORED).unionByName(conform(made, KB_STORED)), root, "kb_chunks",
                         set(touched).difference(_buckets_of(left)))
    kept = known.where(F.col("bucket").isin(touched)).join(names.select("source"), "source", "left_anti")
    sources = conform(kept, KB_SOURCES).unionByName(conform(names, KB_SOURCES))
    lake.replace_buckets(lake.rebalanced(sources, ("bucket",)), root, "kb_sources")


def upsert_stream(versions: DataFrame, root: str, checkpoint: str, every: str | None = None, **options) -> StreamingQuery:
    """`upsert_documents` for each micro-batch of a stream of versions; with `every` the query goes on."""
    writer = (versions.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: upsert_documents(batch, root, **options)))
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def changed_files(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Versions of the files under `path` that are new, were replaced, or are gone since the last time.

    Files are told apart by path and time of modification, from a listing that opens none of
    them; only files at least as new as the oldest change are then read.
    """
    listed = lake.stored(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.col("path").alias("source"), F.col("modificationTime").cast("timestamp_ntz").alias("modified")))
    known = lake.table_or_empty(spark, root, "kb_sources", KB_SOURCES).where(~F.col("deleted"))
    news = lake.stored(listed.join(known.select("source", F.col("modified").alias("_modified")), "source", "left")
                       .where(F.col("_modified").isNull() | (F.col("modified") > F.col("_modified")))
                       .select("source", "modified"))
    gone = (known.join(listed, "source", "left_anti")
            .select("source", F.localtimestamp().alias("modified"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("deleted")))
    since = news.agg(F.min(F.col("modified").cast("timestamp"))).first()[0]
    if since is None:
        return gone
    texts = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .where(F.col("modificationTime") >= F.lit(since))
             .select(F.col("path").alias("source"), F.decode("content", "UTF-8").alias("text")))
    return texts.join(news, "source").select("source", "modified", "text", F.lit(False).alias("deleted")).unionByName(gone)
