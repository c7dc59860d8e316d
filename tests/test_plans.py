"""What the physical plans must show: pushdown, pruning, early limits, no Python."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import invoices as I
from tallyline.plans import catalog
from tallyline.plans import views as V
from tallyline.sources import usage_lake as UL
from tallyline.sources.invoice_table import write_invoices

PYTHON_QUERIES = {"memory_recall", "memory_recall_wide", "put_files", "list_files", "read_files"}
STREAMS = {n for n in catalog.QUERIES if n.startswith("stream_") or n.startswith("usage_ingest") or n.startswith("usage_lake")}


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - PYTHON_QUERIES - STREAMS))
def test_no_python_and_no_pairs(spark, small, name):
    text = plan(catalog.QUERIES[name](spark, small))
    for operator in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    rows = spark.range(10).select(
        F.col("id").alias("invoice_id"), F.lit("c").alias("customer_name"), F.current_date().alias("invoice_date"),
        F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("PAID").alias("status"),
    )
    rows.write.parquet(folder + "/invoices")
    stored = spark.read.parquet(folder + "/invoices")
    text = plan(I.customer_totals(I.filter_invoices(stored, "c", "2024-01-01", "2024-02-01")))
    assert "EqualTo(customer_name,c)" in text and "GreaterThanOrEqual(invoice_date,2024-01-01)" in text
    assert "LessThanOrEqual(invoice_date,2024-02-01)" in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "status" not in schema and "invoice_id" not in schema


def test_stored_invoices_are_clustered(spark, small, folder):
    invoices = V.invoices(spark, small)
    write_invoices(invoices, folder + "/table")
    files = spark.read.parquet(folder + "/table").groupBy(F.input_file_name().alias("file")).agg(
        F.min(F.struct("customer_name", "invoice_date")).alias("low"),
        F.max(F.struct("customer_name", "invoice_date")).alias("high"),
    )
    spans = sorted((r["low"], r["high"]) for r in files.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_lake_days_are_pruned(spark, folder):
    lines = spark.createDataFrame(
        [(f'{{"user_id":"u","ts":"2025-06-0{d} 00:00:00"}}',) for d in range(1, 6)], "value STRING"
    )
    UL.usage_ingest(lines, folder + "/lake")
    rows = UL.read_usage_lake(spark, folder + "/lake", "2025-06-02", "2025-06-03").select("user_id")
    text = plan(rows)
    assert "dt" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert rows.count() == 2 and "ReadSchema: struct<user_id:string>" in text


def test_newest_rows_use_an_early_limit(spark, small):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["recent_invoices"](spark, small))
    for name in ("keyed_put", "topk_per_namespace"):
        assert "Partial" in plan(catalog.QUERIES[name](spark, small)) and "WindowGroupLimit" in plan(
            catalog.QUERIES[name](spark, small)
        )


@pytest.mark.parametrize("name", ["budget_admission", "idle_lifecycle", "chunk_batches", "file_op_status"])
def test_one_shuffle_of_the_rows_when_nothing_is_hot(spark, small, name):
    final = plan(catalog.QUERIES[name](spark, small), final=True).split("== Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    ("name", "scans"),
    [("budget_admission_sliced", 2), ("idle_lifecycle_hours", 2), ("session_registry_sliced", 2), ("file_op_status_sliced", 1)],
)
def test_keys_over_several_ranges_are_read_twice_at_most(spark, small, name, scans):
    text = plan(catalog.QUERIES[name](spark, small))  # the registry reads assignments and failures
    assert "_groups" in text and text.count("FileScan parquet") <= scans


def test_totals_are_combined_before_the_shuffle(spark, small):
    for name in ("customer_totals", "usage_report", "usage_counters", "first_decision", "tool_call_audit"):
        assert "partial_" in plan(catalog.QUERIES[name](spark, small))


def exchanged(spark, small, name):
    """The plan lines of each shuffle, with what stands below it up to the next one."""
    lines = plan(catalog.QUERIES[name](spark, small)).splitlines()
    return [lines[k : k + 3] for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_calls_are_counted_where_they_are(spark, small):
    (below,) = exchanged(spark, small, "tool_call_audit")
    assert "partial_count" in "".join(below)
    text = plan(catalog.QUERIES["tool_call_audit"](spark, small))
    assert "BroadcastHashJoin" in text and text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin")


def test_orders_stay_where_they_are(spark, small):
    text = plan(catalog.QUERIES["status_lookup"](spark, small))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_bodies_are_not_shuffled_to_find_the_last_change(spark, small):
    text = plan(catalog.QUERIES["file_log_compact"](spark, small))
    assert "partial_max(seq" in text and "Window" not in text


def test_no_row_is_paired_by_range_lookup(spark, small):
    text = plan(I.range_lookup(V.range_requests(spark, small), V.invoices(spark, small)))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all(">=" not in line for line in joins)


@pytest.mark.parametrize("name, parse", [("decision_log", "ParseUrlEvaluator"), ("normalize_chat", "from_json")])
def test_parsed_once(spark, small, name, parse):
    assert plan(catalog.QUERIES[name](spark, small)).count(parse) == 1
