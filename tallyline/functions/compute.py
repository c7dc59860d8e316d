"""Keeping an expensive column from being computed more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import work_dir


SMALL_ROWS = 10_000


def broadcast_if_small(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A reference table with a broadcast hint if it has at most `rows` rows, else as it is.

    Tables made from Python values have no size that Spark knows, so it would shuffle the
    large side to meet them.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def once(value: Column) -> Column:
    """The same value, computed once.

    Filters on a plain column are copied down to the scan together with its expression, so
    a parse would run again for each of them. Nothing is copied below a generator.
    """
    return F.explode(F.array(value))


def stored(table: DataFrame) -> DataFrame:
    """Rows that several steps read, written once to the shared folder where the session has one.

    Without `spark.checkpoint.dir` they are computed again by each step.
    """
    spark = table.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        return table
    path = work_dir(spark, "stored")
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
