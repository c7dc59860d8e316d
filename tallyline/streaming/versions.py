"""A small table kept between micro-batches as alternating Parquet versions.

Batch `n` reads what batch `n - 1` wrote and writes its own version beside it, so running
batch `n` again after a lost driver or executor gives the same table. Two folders are
enough: the older one is only overwritten once the newer one is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VERSION = "_version"
# Keyed state of any shape needs the store that keeps it on disk and logs its changes.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _slot(path: str, version: int) -> str:
    return f"{path}/slot={version % 2}"


def before_batch(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """The table as the batch before left it; empty for the first batch."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_slot(path, batch_id - 1))


def write_version(table: DataFrame, path: str, batch_id: int) -> None:
    table.withColumn(_VERSION, F.lit(batch_id)).write.mode("overwrite").parquet(_slot(path, batch_id))


def read_newest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table as the last finished batch left it."""
    slots = spark.read.schema(f"{schema}, {_VERSION} INT, slot INT").parquet(path)
    newest = slots.agg(F.max(_VERSION)).first()[0]
    return slots.filter(F.col(_VERSION) == F.lit(newest)).drop(_VERSION, "slot")


def batch_folder(path: str, batch_id: int) -> str:
    """Where one micro-batch writes its rows; written with overwrite, so a repeat is harmless."""
    return f"{path}/batch_id={batch_id}"


@contextmanager
def stateful_start(spark: SparkSession, partitions: int | None, more: dict | None = None) -> Iterator[None]:
    """The settings a stateful query is started with.

    A query keeps its number of state partitions for as long as its checkpoint lives, so it
    is chosen by the size of the state rather than left to the session. Sessions are merged
    before the shuffle, so that a busy one arrives as few rows.
    """
    wanted = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"} | (more or {})
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    partitions: int | None = None,
):
    """Start a query that hands every micro-batch to `each`; by default it stops at the end
    of the available input."""
    writer = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with stateful_start(stream.sparkSession, partitions):
        return writer.start()
