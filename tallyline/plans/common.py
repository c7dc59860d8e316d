"""What the query catalogues share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import session

Query = Callable[[SparkSession, str], DataFrame]

# The same view of events as `views.requests`, in SQL.
USAGE_SQL = """usage AS (
  SELECT cast(user_id AS varchar) AS user_id, cast(event_id AS varchar) AS request_id, ts,
         cast(json_extract_string(props, '$.k') AS bigint) AS tokens_in,
         cast(floor(value) AS bigint) AS tokens_out
  FROM events)"""
USAGE_MONTHS_SQL = USAGE_SQL.replace(" ts,", " ts + to_days(cast(user_id % 3 * 31 AS integer)) AS ts,")

INVOICES_SQL = """invoices AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS customer_name, cast(o_orderdate AS date) AS invoice_date,
         cast(o_totalprice AS decimal(18,2)) AS amount, o_orderstatus AS status
  FROM orders)"""


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh shared folder; a local session without `spark.checkpoint.dir` gets its own."""
    unset = not spark.conf.get("spark.checkpoint.dir", None)
    if unset and spark.sparkContext.master.startswith("local["):
        return tempfile.mkdtemp(prefix=f"tallyline-{label}-")
    return session.work_dir(spark, label)


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: naive timestamps, doubles for money, wide integers."""
    casts = {"timestamp": "timestamp_ntz", "int": "bigint"}
    columns = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else casts.get(kind)
        columns.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*columns)
