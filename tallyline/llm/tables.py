"""Tables kept between steps, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.stored import remove

BROADCAST_ROWS = 500_000
ARROW_BYTES, DEFAULT_BYTES, SMALL_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 1 << 20


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyline-shared-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`; only a local session may do without it."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = _local_folder()
    return f"{_own(spark, top)}/{uuid.uuid4().hex}"


def _own(spark: SparkSession, top: str) -> str:
    return f"{top.rstrip('/')}/tallyline-llm/{spark.sparkContext.applicationId}"


def drop_kept(spark: SparkSession) -> None:
    """Remove all tables and files this application has kept; results that read them end with them."""
    top = spark.conf.get("spark.checkpoint.dir", None) or _local_folder()
    remove(_own(spark, top))


def kept(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet and read back: lineage ends here, on shared storage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has at most `rows` rows, else as it is.

    For tables of a few fixed-width columns that are already stored, so counting is cheap.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of 1 MB, if it has the default of 64 MB.

    A batch is held by the JVM, on its way, and by the worker, so it counts several times.
    """
    if spark.conf.get(ARROW_BYTES).rstrip("b") == str(DEFAULT_BYTES):
        spark.conf.set(ARROW_BYTES, str(SMALL_BYTES))
