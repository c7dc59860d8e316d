"""Order approval: notices, decisions, matching inside the waiting time, status texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.compute import broadcast_if_small, once
from tallyline.functions.defaults import if_empty, if_missing
from tallyline.functions.skew import HOT_ROWS, hot_keys, salted_join
from tallyline.operators.invoices import plain_amount

# Statuses, waiting time, default decision, status texts of the demo orders.
PENDING, APPROVED, REJECTED = "PENDING_APPROVAL", "APPROVED", "REJECTED"
APPROVE, REJECT = "approve", "reject"
WAIT_DAYS = 2
ORDER_STATUS = [
    ("A1001", "shipped — arriving tomorrow"),
    ("A1002", "processing — leaves the warehouse today"),
    ("A1003", "delivered on 2026-06-30"),
]


def approval_notices(orders: DataFrame, base_url: str, sender: str) -> DataFrame:
    """One notice per order (order_id, cb, item, amount, customer_email): both links,
    recipient, subject and body."""
    link = F.concat(F.lit(f"{base_url}?cb="), F.col("cb"), F.lit("&decision="))
    notices = (
        orders.withColumn("approve_url", F.concat(link, F.lit(APPROVE)))
        .withColumn("reject_url", F.concat(link, F.lit(REJECT)))
        .withColumn("recipient", if_empty(F.col("customer_email"), sender))
        .withColumn("subject", F.concat(F.lit("Approve order "), "order_id", F.lit("?")))
    )
    amount = F.col("amount")
    if dict(orders.dtypes)["amount"].startswith("decimal"):
        amount = plain_amount(amount)
    # Fixed value: the text of a notice.
    body = F.format_string(
        "<p>Order <b>%s</b> for $%s.</p><p><a href='%s'>✅ Approve</a>&nbsp;&nbsp;"
        "<a href='%s'>❌ Reject</a></p>",
        "item",
        amount.cast("string"),
        "approve_url",
        "reject_url",
    )
    return notices.select(
        "order_id", "recipient", "subject", "approve_url", "reject_url", body.alias("body")
    )


def decided_status(decision: Column) -> Column:
    """Exactly `approve` approves; anything else rejects."""
    return F.when(decision == APPROVE, APPROVED).otherwise(REJECTED)


def decision_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An access log (url, ts, ...) to decisions, and the rejected calls without a callback id."""
    parsed = log.withColumn("_query", once(F.try_parse_url(F.col("url"), F.lit("QUERY")))).withColumn(
        "cb", F.nullif(_parameter("cb"), F.lit(""))
    )
    good = (
        parsed.filter(F.col("cb").isNotNull())
        .withColumn("decision", if_missing(_parameter("decision"), REJECT))
        .withColumn("status", decided_status(F.col("decision")))
        .drop("url", "_query")
    )
    rejects = parsed.filter(F.col("cb").isNull()).drop("cb", "_query").withColumn("code", F.lit(400))
    return good, rejects


def _parameter(name: str) -> Column:
    """A decoded parameter of the query string; NULL where it is absent."""
    query = F.concat(F.lit("&"), F.col("_query"))
    after = F.substring_index(query, f"&{name}=", -1)
    return F.when(query.contains(f"&{name}="), F.try_url_decode(F.substring_index(after, "&", 1)))


def first_decision(decisions: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first decision of each callback; later ones are ignored.

    Where several are equal in `order_by`, the smallest in the other columns counts, so the
    answer does not depend on how the rows are stored. Combined before the shuffle.
    """
    rest = [c for c in decisions.columns if c not in keys and c not in order_by]
    first = decisions.groupBy(*keys).agg(F.min(F.struct(*order_by, *rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*decisions.columns)


def order_decisions(
    orders: DataFrame,
    decisions: DataFrame,
    as_of: Column,
    wait_days: int = WAIT_DAYS,
    hot_rows: int = HOT_ROWS,
    tie: str | None = None,
) -> DataFrame:
    """Orders (order_id, submitted, ...) with their first decision (cb, ts, decision) taken
    between submission and `wait_days` later, both ends included.

    Without one the order stays pending, and `timed_out` tells whether `as_of` is past the
    waiting time. A callback called very often is spread over tasks before the join, and
    only the first decision of an order leaves it.
    """
    order_by = ["ts", tie] if tie else ["ts"]
    wait = F.make_dt_interval(days=F.lit(wait_days))
    calls = decisions.select(F.col("cb").alias("order_id"), *order_by, "decision")
    window = salted_join(
        orders.select("order_id", "submitted"),
        calls,
        ["order_id"],
        hot_keys(calls, ["order_id"], hot_rows),
        F.struct(*order_by),
    ).filter((F.col("ts") >= F.col("submitted")) & (F.col("ts") <= F.col("submitted") + wait))
    first = first_decision(window.select("order_id", *order_by, "decision"), ["order_id"], order_by)
    return (
        orders.join(
            first.select("order_id", F.col("ts").alias("decided_at"), "decision"), "order_id", "left"
        )
        .withColumn(
            "status", F.when(F.col("decided_at").isNull(), PENDING).otherwise(decided_status(F.col("decision")))
        )
        .withColumn("timed_out", F.col("decided_at").isNull() & (as_of > F.col("submitted") + wait))
    )


def status_lookup(orders: DataFrame, status: DataFrame) -> DataFrame:
    """Each order id with its status text, or a text saying there is no such order.

    A status table of few rows meets the orders where they are, without a shuffle.
    """
    missing = F.concat(F.lit("No order found with ID "), F.col("order_id"), F.lit("."))
    return orders.join(broadcast_if_small(status), "order_id", "left").withColumn("message", F.coalesce("message", missing))


def status_table(spark) -> DataFrame:
    return spark.createDataFrame(ORDER_STATUS, "order_id STRING, message STRING")
