"""Scoring of feature rows as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow.operators.dedup import latest_per_group
from wardflow.operators.forecast import predict
from wardflow.schemas import GOLD_FEATURES, PREDICTIONS, conform
from wardflow.sources import lake


def score_stream(features: DataFrame, models: dict[int, PipelineModel], version: str,
                 path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Predictions for every feature row of the stream, under `path`.

    Each micro-batch replaces its own batch_id folder, so a batch repeated after a failure
    leaves no double rows. `every` ('15 minutes') keeps the query running; without it the
    query ends when the input is used up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        scored = predict(batch, models).select(
            "sector_id", "window_start", F.lit(version).alias("model_version"),
            *[F.col(f"predicted_arrivals_h{h}") for h in models],
            F.lit(batch_id).alias("batch_id"))
        (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    writer = features.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def score_latest_stream(features: DataFrame, models: dict[int, PipelineModel], version: str, root: str,
                        checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Predictions for the newest feature row of each sector, stored in the predictions table.

    The state is that row, one per sector, in a folder per micro-batch under the checkpoint. A batch
    reads the state before it and writes its own, so one that is repeated after a failure finds
    what it found the first time and replaces its own run of predictions; rows that arrive out of order
    never bring an older hour back. A sector is scored when its newest hour moves on, so each (sector, feature
    hour, version) is stored once. `every` ('15 minutes') keeps the query running.
    """
    spark, columns = features.sparkSession, GOLD_FEATURES.fieldNames()

    def work(batch: DataFrame, batch_id: int) -> None:
        folder = f"{checkpoint}/sectors"
        before = (spark.read.schema(GOLD_FEATURES).parquet(f"{folder}/batch={batch_id - 1}") if batch_id
                  else spark.createDataFrame([], GOLD_FEATURES))
        newest = latest_per_group(batch.select(*columns).unionByName(before.select(*columns)), ["sector_id"], "window_start")
        newest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        now = spark.read.schema(GOLD_FEATURES).parquet(f"{folder}/batch={batch_id}")
        moved = now.join(before.select("sector_id", F.col("window_start").alias("_before")), "sector_id", "left").where(
            F.col("_before").isNull() | (F.col("window_start") > F.col("_before"))).drop("_before")
        scored = predict(moved, models).withColumns({
            "prediction_ts": F.col("window_start"), "model_version": F.lit(version)})
        stored = conform(scored.withColumn("dt", F.to_date("window_start")), PREDICTIONS)
        lake.replace_run(stored, root, "gold_predictions", f"stream-{version}-{batch_id}")

    writer = features.writeStream.foreachBatch(work).option("checkpointLocation", f"{checkpoint}/query")
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
