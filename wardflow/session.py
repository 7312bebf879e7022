"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup keys, open windows) lives off heap and on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python are bounded by bytes as well as rows: texts may be very long."""
    if int(spark.conf.get(_BATCH_BYTES, str(2**31 - 1))) > BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def build_session(app: str = "wardflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may go without it: there one process reads and writes, so a
    temporary folder is made and remembered in the session settings.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("wardflow.shared.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="wardflow-")
    spark.conf.set("wardflow.shared.dir", made)
    return made


def run_dir(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_dir(spark)}/wardflow/{label}-{uuid.uuid4().hex}"
