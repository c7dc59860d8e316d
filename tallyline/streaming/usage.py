"""Streaming metering: counters, admission, and the usage lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.keyed import keyed_merge
from tallyline.operators.usage import (
    COUNTER_DAYS,
    TENANT_MONTH,
    budget_admission,
    period_of,
    ttl_filter,
    usage_counters,
)
from tallyline.schemas import COUNTERS
from tallyline.sources.key_table import BUCKETS, KeyTable
from tallyline.sources.usage_lake import compact_usage_lake, in_areas, parse_usage, write_commit
from tallyline.streaming.versions import batch_folder, start_batches

LAKE_TRIGGER = {"processingTime": "60 seconds"}
COMPACT_EVERY = 60


def counter_table(spark: SparkSession, counters: str, buckets: int = BUCKETS) -> KeyTable:
    """The counters of all tenant-months, stored by key."""
    return KeyTable(spark, counters, TENANT_MONTH, COUNTERS, buckets, expires="expires_at")


def _charge(counters: DataFrame, accepted: DataFrame) -> DataFrame:
    """Counters after charging accepted requests; the expiry stays that of the first write."""
    return keyed_merge(
        counters,
        accepted.withColumn("_no", F.lit(0)),
        TENANT_MONTH,
        ["_no"],
        add=["total_tokens", "tokens_in", "tokens_out", "requests"],
        set_if_absent=["expires_at"],
    )


def _charge_batch(table: KeyTable, batch_id: int, batch: DataFrame, accepted: DataFrame, purge: bool) -> None:
    """Charge accepted requests; with `purge`, drop counters expired at the batch's newest request."""
    newest = batch.agg(F.max("ts")).first()[0] if purge else None
    if newest is None:
        table.apply(batch_id, usage_counters(accepted), _charge)
        return
    now = F.lit(newest).cast("timestamp")
    table.apply(
        batch_id,
        usage_counters(accepted),
        lambda counters, charged: _charge(ttl_filter(counters, now, COUNTER_DAYS), charged),
        now=newest,
    )


def stream_usage_counters(
    accepted: DataFrame,
    counters: str,
    checkpoint: str,
    trigger: dict | None = None,
    purge: bool = False,
    buckets: int = BUCKETS,
):
    """Keep the counter table at `counters` up to date with a stream of accepted requests.

    A micro-batch is summed per tenant-month before it meets the table, and only the buckets of
    its tenant-months are read and written again (`sources.key_table`). With `purge`, expired
    counters leave the table: a bucket knows its first expiry and is written again by then.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        _charge_batch(counter_table(batch.sparkSession, counters, buckets), batch_id, batch, batch, purge)

    return start_batches(accepted, each, checkpoint, trigger)


def read_counters(spark: SparkSession, counters: str) -> DataFrame:
    return counter_table(spark, counters).read()


def stream_budget_admission(
    requests: DataFrame,
    limit: int,
    decisions: str,
    counters: str,
    checkpoint: str,
    trigger: dict | None = None,
    purge: bool = False,
    buckets: int = BUCKETS,
    parts: int | None = None,
):
    """Admit or reject a stream of requests against the counters of the batches before.

    Decisions go to `decisions`, one folder per batch. Inside a batch the batch operator
    decides in time order, a busy tenant being cut into ranges. Of the counters, only the
    buckets of the batch's tenant-months are read, and written again if it was charged.
    Requests that arrive in a later batch count as later: the answer equals the batch answer
    when arrival is in order. With `purge`, a counter ends with its month's expiry.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = counter_table(spark, counters, buckets)
        batch = batch.persist()
        try:
            asking = batch.select("user_id", period_of("ts").alias("period"))
            base = table.read(batch_id - 1, table.touched(asking, batch_id - 1))
            used = base.select(*TENANT_MONTH, F.col("total_tokens").alias("used"))
            out = batch_folder(decisions, batch_id)
            decided = budget_admission(batch, limit, used, parts=parts)
            decided.write.mode("overwrite").parquet(out)
            accepted = spark.read.schema(decided.schema).parquet(out).filter("accepted")
            _charge_batch(table, batch_id, batch, accepted, purge)
        finally:
            batch.unpersist()

    return start_batches(requests, each, checkpoint, trigger)


def usage_lake_write(
    records: DataFrame,
    path: str,
    checkpoint: str,
    dt_from: str = "event",
    trigger: dict | None = None,
):
    """Append a stream of usage records to the lake by day, by default every 60 seconds.

    The native file sink commits each batch exactly once.
    """
    return (
        in_areas(records, dt_from)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("area", "dt")
        .trigger(**(trigger or LAKE_TRIGGER))
        .start()
    )


def stream_usage_lake(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    dt_from: str = "event",
    trigger: dict | None = None,
    compact_every: int | None = COMPACT_EVERY,
):
    """A stream of usage JSON lines to the lake, bad lines to its error area.

    Each batch owns its commit folders and overwrites only those, so a repeated batch leaves
    no duplicates; its files follow the advisory size. Every `compact_every` batches, days
    with more than as many commits are compacted, so the files of a day stay few. When
    repeated after midnight, `arrival` days may differ; use `event` where that matters.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write_commit(parse_usage(batch), path, f"s-{batch_id:012d}", dt_from)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_usage_lake(batch.sparkSession, path, compact_every)

    return start_batches(lines, each, checkpoint, trigger or LAKE_TRIGGER)
