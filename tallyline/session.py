"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


SHUFFLE_PARTITION_BYTES = 256 << 20


def build_session(
    app: str = "tallyline", master: str | None = None, shuffle_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings the operators are tuned for; `extra` uses `__` for dots.

    `shuffle_bytes`, the size of the largest table to be shuffled, sets the number of shuffle
    partitions so that each fits an executor; smaller shuffles are coalesced at run time.
    """
    if shuffle_bytes:
        partitions = max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        extra = {"spark__sql__shuffle__partitions": str(partitions), **extra}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, under the session's `spark.checkpoint.dir`."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared.rstrip('/')}/tallyline/{label}-{uuid.uuid4().hex}"
