"""Invoices: look-ups, range look-ups, totals, histories, and the tool-call audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.compute import broadcast_if_small, once
from tallyline.functions.prefix import in_pages

# The three tools, their required arguments, and the default list length.
TOOLS = [
    ("get_invoice_by_id", ["invoice_id"]),
    ("get_invoices_by_customer", ["customer_name"]),
    ("list_recent_invoices", []),
]
RECENT_LIMIT = 10

INVOICE = ["invoice_id", "customer_name", "invoice_date", "amount", "status"]


def _money(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("decimal(18,2)")


def _date_or_open(value) -> Column:
    """A date bound; NULL and the empty string mean no bound, and so does what is no date."""
    column = value if isinstance(value, Column) else F.lit(value)
    return F.try_to_date(F.nullif(column.cast("string"), F.lit("")))


def _date_error() -> Column:
    """The text of a bound that is no date, or NULL."""
    bad = [
        F.when(F.nullif(F.col(c).cast("string"), F.lit("")).isNotNull() & _date_or_open(F.col(c)).isNull(), F.concat(F.lit(f"{c} is no date: "), F.col(c).cast("string")))
        for c in ("start_date", "end_date")
    ]
    return F.coalesce(*bad)


def filter_invoices(
    invoices: DataFrame, customer: str | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Invoices of one customer (or of all) in an inclusive date range with open ends.

    Rows without a customer or a date are not in the customer index, so they never match.
    """
    result = invoices.filter(F.col("invoice_date").isNotNull() & F.col("customer_name").isNotNull())
    if customer is not None:
        result = result.filter(F.col("customer_name") == F.lit(customer))
    if start:
        result = result.filter(F.col("invoice_date") >= F.lit(start).cast("date"))
    if end:
        result = result.filter(F.col("invoice_date") <= F.lit(end).cast("date"))
    return result


def lookup_by_key(requests: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Every request with the row of its key, and `found`."""
    return (
        requests.join(rows.withColumn("_hit", F.lit(True)), key, "left")
        .withColumn("found", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def range_lookup(requests: DataFrame, invoices: DataFrame) -> DataFrame:
    """Count and exact total per request (request_id, customer_name, start_date, end_date).

    No request is paired with its invoices. Invoices are first added up per customer and
    day; a running total over those days is read off at the two ends of each range. Days
    and range ends per customer are bounded by the calendar, whatever the customer's size.

    A bound that is no date gives that one request an `error`, and no count or total.
    """
    requests = requests.withColumn("error", _date_error())
    requests = requests.withColumn("_from", _date_or_open(F.col("start_date"))).withColumn(
        "_to", _date_or_open(F.col("end_date"))
    )
    # An end date is read after its own day, a start date before it; an open start needs no
    # reading and an open end reads the last day.
    last = F.lit("9999-12-31").cast("date")
    ends = requests.select("customer_name", F.coalesce("_to", last).alias("_day"), F.lit(2).alias("_at"))
    starts = requests.filter(F.col("_from").isNotNull()).select(
        "customer_name", F.col("_from").alias("_day"), F.lit(0).alias("_at")
    )
    readings = (
        ends.unionByName(starts)
        .distinct()
        .withColumn("_n", F.lit(0).cast("bigint"))
        .withColumn("_sum", F.lit(0).cast("decimal(28,2)"))
    )
    days = (
        filter_invoices(invoices)
        .groupBy("customer_name", F.col("invoice_date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(_money("amount")).alias("_sum"))
        .withColumn("_at", F.lit(1))
    )
    running = (
        Window.partitionBy("customer_name")
        .orderBy("_day", "_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = (
        days.unionByName(readings)
        .withColumn("_n", F.sum("_n").over(running))
        .withColumn("_sum", F.sum("_sum").over(running))
    )
    to = read.filter("_at = 2").select("customer_name", F.col("_day").alias("_end"), "_n", "_sum")
    before = read.filter("_at = 0").select(
        "customer_name", F.col("_day").alias("_from"), F.col("_n").alias("_n0"), F.col("_sum").alias("_sum0")
    )
    in_order = F.col("_from").isNull() | F.col("_to").isNull() | (F.col("_from") <= F.col("_to"))
    count = F.coalesce("_n", F.lit(0)) - F.coalesce("_n0", F.lit(0))
    total = F.coalesce("_sum", F.lit(0)) - F.coalesce("_sum0", F.lit(0))
    return (
        requests.withColumn("_end", F.coalesce("_to", last))
        .join(to, ["customer_name", "_end"], "left")
        .join(before, ["customer_name", "_from"], "left")
        .withColumn("count", F.when(F.col("error").isNull(), F.when(in_order, count).otherwise(0).cast("bigint")))
        .withColumn(
            "total_amount", F.when(F.col("error").isNull(), F.when(in_order, total).otherwise(0).cast("decimal(28,2)"))
        )
        .drop("_from", "_to", "_end", "_n", "_sum", "_n0", "_sum0")
    )


def range_lookup_rows(requests: DataFrame, invoices: DataFrame) -> DataFrame:
    """The invoices each request matches, one row per match.

    Joined on customer and month, so a large customer is spread over its months and only
    the two end months of a range are tested by date. Requests with a bound that is no date
    match nothing (see `range_lookup`).
    """
    requests = requests.filter(_date_error().isNull())
    requests = requests.withColumn("_from", _date_or_open(F.col("start_date"))).withColumn(
        "_to", _date_or_open(F.col("end_date"))
    )
    invoices = filter_invoices(invoices).withColumn("_month", F.trunc("invoice_date", "month"))
    months = invoices.select("customer_name", "_month").distinct()
    wanted = requests.join(months, "customer_name").filter(
        (F.col("_from").isNull() | (F.col("_month") >= F.trunc("_from", "month")))
        & (F.col("_to").isNull() | (F.col("_month") <= F.col("_to")))
    )
    return (
        wanted.join(invoices, ["customer_name", "_month"])
        .filter(
            (F.col("_from").isNull() | (F.col("invoice_date") >= F.col("_from")))
            & (F.col("_to").isNull() | (F.col("invoice_date") <= F.col("_to")))
        )
        .drop("_from", "_to", "_month")
    )


def customer_totals(invoices: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per customer in the date range: invoice count and exact total."""
    return (
        filter_invoices(invoices, None, start, end)
        .groupBy("customer_name")
        .agg(F.count(F.lit(1)).alias("count"), F.sum(_money("amount")).alias("total_amount"))
    )


def customer_statements(
    invoices: DataFrame,
    start: str | None = None,
    end: str | None = None,
    page_rows: int = 1000,
    parts: int | None = None,
) -> DataFrame:
    """Per customer, the invoices of the range in date order with count and total.

    The list comes in pages of at most `page_rows` invoices, so that the row of a very large
    customer stays small; an ordinary customer has one page.
    """
    rows = filter_invoices(invoices, None, start, end)
    listed = F.array_sort(F.collect_list(F.struct("invoice_date", "invoice_id", "amount", "status")))
    pages = in_pages(
        rows,
        ["customer_name"],
        ["invoice_date", "invoice_id"],
        "page",
        page_rows,
        listed.alias("invoices"),
        parts=parts,
    )
    return pages.join(customer_totals(invoices, start, end), "customer_name")


def recent_invoices(invoices: DataFrame, n: int = RECENT_LIMIT) -> DataFrame:
    """The newest `n` invoices of all customers; undated ones come last."""
    return invoices.orderBy(F.desc_nulls_last("invoice_date"), "invoice_id").limit(n)


def customer_history(invoices: DataFrame, customer: str) -> DataFrame:
    """All invoices of one customer in date order."""
    return filter_invoices(invoices, customer).orderBy("invoice_date", "invoice_id")


def export_amount(amount: Column) -> Column:
    """A decimal as a JSON number: whole amounts as integers, others in plain notation."""
    return F.parse_json(plain_amount(amount))


def plain_amount(amount: Column) -> Column:
    """A decimal as text without trailing zeros."""
    text = amount.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def tool_call_audit(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Outcome counts per tool of a call log (context_name, event as JSON text).

    The name is the context name, else the event's `tool_name`, else its `toolName`, and of
    that the part after the last `___`. Arguments are the event's `arguments` object or
    else the event itself. `tools` has (tool, required); it meets the calls where they are, and
    calls are counted there before counts are shuffled.
    """
    event = F.try_parse_json("event")
    arguments = F.try_variant_get("_event", "$.arguments", "variant")
    nested = F.schema_of_variant(arguments).startswith("OBJECT")
    name = F.coalesce(
        *[
            F.nullif(c, F.lit(""))
            for c in (
                F.col("context_name"),
                F.try_variant_get("_event", "$.tool_name", "string"),
                F.try_variant_get("_event", "$.toolName", "string"),
            )
        ]
    )
    parsed = (
        calls.withColumn("_event", once(event))
        .withColumn("tool", F.element_at(F.split(name, "___"), -1))
        .withColumn("_args", F.to_json(F.when(nested, arguments).otherwise(F.col("_event"))))
        .withColumn("_given", F.coalesce(F.json_object_keys("_args"), F.array().cast("array<string>")))
    )
    missing = F.size(F.array_except("required", "_given")) > 0
    outcome = (
        F.when(F.col("required").isNull(), "unknown tool")
        .when(missing, "missing required argument")
        .otherwise("ok")
    )
    return (
        parsed.join(broadcast_if_small(tools.select("tool", "required")), "tool", "left")
        .groupBy("tool", outcome.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("calls"))
    )


def tool_table(spark) -> DataFrame:
    return spark.createDataFrame(TOOLS, "tool STRING, required ARRAY<STRING>")
