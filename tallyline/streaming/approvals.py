"""Streaming order approval: an interval join with a time-out.

Orders and decisions come as one stream of micro-batches. A batch meets what the batches before
left waiting, in one batch join, and leaves what later ones may still need: orders until the
watermark is past their waiting time, decisions until it is past them. Both wait as Parquet
beside the table, so neither the memory of a task nor a state store bounds them, and a row that
is settled in its own batch never becomes state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.skew import HOT_ROWS, hot_keys, salted_join
from tallyline.operators.approvals import PENDING, WAIT_DAYS, decided_status, first_decision
from tallyline.streaming.versions import batch_folder, before_batch, start_batches, write_version

# Sorts an order without a decision behind any decision.
_NEVER = "9999-12-31"
_HASHES = 1 << 16
_MARKS = "submitted TIMESTAMP, ts TIMESTAMP"


def stream_order_decisions(
    orders: DataFrame,
    decisions: DataFrame,
    table: str,
    checkpoint: str,
    wait_days: int = WAIT_DAYS,
    delay: str = "1 hour",
    trigger: dict | None = None,
    partitions: int | None = None,
    salts: int = 4,
    hot_rows: int = HOT_ROWS,
):
    """Match a stream of orders (order_id, submitted) to decisions (cb, ts, line, decision).

    The watermark is `delay` behind the newest time of the stream that is further back. Matches
    come out at once, a row without a decision for an order once the watermark is past its waiting
    time. Each batch adds its earliest decision per order to `table`; reading takes the earliest
    of all batches, so the order of arrival does not matter. What waits is kept in
    `<table>-orders` and `<table>-calls`. An order that comes behind the watermark of the batches
    before is left out, a decision still meets the orders that wait.

    A callback of more than `hot_rows` calls is spread over `salts` tasks, and its order repeated
    as often.
    """
    kinds = dict(orders.dtypes) | dict(decisions.dtypes)
    order, call = ["order_id", "submitted"], ["cb", "ts", "line", "decision"]

    def rows(stream: DataFrame, own: list[str]) -> DataFrame:
        columns = [F.col(x) if x in own else F.lit(None).cast(kinds[x]).alias(x) for x in [*order, *call]]
        return stream.select(F.lit(own is order).alias("_is_order"), *columns)

    def waited(spark: SparkSession, name: str, batch_id: int, columns: list[str]) -> DataFrame:
        return before_batch(spark, f"{table}-{name}", batch_id, ", ".join(f"{x} {kinds[x]}" for x in columns))

    def each(batch: DataFrame, batch_id: int) -> None:
        spark, wait = batch.sparkSession, F.expr(f"INTERVAL {int(wait_days)} DAYS")
        marks = before_batch(spark, f"{table}-marks", batch_id, _MARKS)
        seen = marks.unionByName(batch.select("submitted", "ts")).agg(F.max("submitted").alias("submitted"), F.max("ts").alias("ts"))
        write_version(seen, f"{table}-marks", batch_id)
        late = _watermark(marks, delay)
        now = _watermark(before_batch(spark, f"{table}-marks", batch_id + 1, _MARKS), delay)
        new_orders = batch.filter("_is_order AND submitted IS NOT NULL").select(*order)
        if late is not None:
            new_orders = new_orders.filter(F.col("submitted") > late)
        new_calls = batch.filter("NOT _is_order AND cb IS NOT NULL AND ts IS NOT NULL").select(*call)
        asking = _with_new(waited(spark, "orders", batch_id, order), new_orders, "_new_order")
        calls = _with_new(waited(spark, "calls", batch_id, call), new_calls, "_new_call")
        over = F.lit(False) if now is None else F.col("submitted") + wait <= now

        given_up = asking.filter(over).select(*order, *[F.lit(None).cast(kinds[x]).alias(x) for x in call[1:]])
        found = _pairs(asking, calls, wait, salts, hot_rows).select(*order, *call[1:]).unionByName(given_up)
        _earliest(found.withColumnRenamed("ts", "decided_at")).write.mode("overwrite").parquet(batch_folder(table, batch_id))
        write_version(asking.filter(~over).select(*order), f"{table}-orders", batch_id)
        later = calls if now is None else calls.filter(F.col("ts") > now)
        write_version(later.select(*call), f"{table}-calls", batch_id)

    return start_batches(rows(orders, order).unionByName(rows(decisions, call)), each, checkpoint, trigger, partitions)


def _watermark(marks: DataFrame, delay: str) -> Column | None:
    """`delay` before the newest time of the stream that is further back; none before both have one."""
    least = F.when(F.col("submitted").isNotNull() & F.col("ts").isNotNull(), F.least("submitted", "ts"))
    at = F.unix_micros(F.date_trunc("millisecond", least) - F.expr(f"INTERVAL {delay}"))
    found = marks.select(at.alias("at")).first()
    return None if found is None or found["at"] is None else F.timestamp_micros(F.lit(found["at"]))


def _with_new(waited: DataFrame, new: DataFrame, flag: str) -> DataFrame:
    return waited.withColumn(flag, F.lit(False)).unionByName(new.withColumn(flag, F.lit(True)))


def _pairs(orders: DataFrame, calls: DataFrame, wait: Column, salts: int, hot_rows: int) -> DataFrame:
    """Orders with each call in their waiting time, but for pairs that an earlier batch has seen."""
    calls = calls.withColumnRenamed("cb", "order_id")
    # counts by hash, a few for each task, tell which callbacks have to be counted
    numbered = calls.select("order_id", F.pmod(F.xxhash64("order_id"), F.lit(_HASHES)).alias("_hash"))
    full = numbered.groupBy("_hash").count().filter(F.col("count") > hot_rows).select("_hash")
    hot = hot_keys(numbered.join(F.broadcast(full), "_hash", "left_semi"), ["order_id"], hot_rows)
    pairs = salted_join(orders, calls, ["order_id"], hot, F.struct("ts", "line"), salts)
    in_time = (F.col("ts") >= F.col("submitted")) & (F.col("ts") <= F.col("submitted") + wait)
    return pairs.filter(in_time & (F.col("_new_order") | F.col("_new_call")))


def _earliest(rows: DataFrame) -> DataFrame:
    timed = rows.withColumn("_at", F.coalesce("decided_at", F.lit(_NEVER).cast("timestamp")))
    return first_decision(timed, ["order_id"], ["_at", "line"]).drop("_at")


def read_order_status(
    spark: SparkSession, table: str, orders: DataFrame, log: DataFrame | None = None, wait_days: int = WAIT_DAYS
) -> DataFrame:
    """All orders with their status so far; `timed_out` once the stream has given up waiting.

    A decision that reached the stream behind its watermark is not in `table`. With the stored
    `log` of decisions (cb, ts, line, decision), all of them count, late ones too.
    """
    stored = spark.read.parquet(table).drop("submitted", "batch_id")
    if log is not None:
        times = orders.select("order_id", "submitted")
        calls = log.select(F.col("cb").alias("order_id"), F.col("ts").alias("decided_at"), "line", "decision")
        in_time = F.expr(f"decided_at BETWEEN submitted AND submitted + INTERVAL {int(wait_days)} DAYS")
        stored = stored.unionByName(calls.join(times, "order_id").filter(in_time).drop("submitted"))
    seen = _earliest(stored).withColumn("_seen", F.lit(True))
    return orders.join(seen, "order_id", "left").select(
        *orders.columns,
        "decided_at",
        F.when(F.col("decided_at").isNull(), PENDING).otherwise(decided_status(F.col("decision"))).alias("status"),
        (F.col("_seen").isNotNull() & F.col("decided_at").isNull()).alias("timed_out"),
    )
