"""Known small answers: the sample invoices, order texts and metering examples."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tallyline.operators import approvals as AP
from tallyline.operators import invoices as I
from tallyline.operators import keyed as K
from tallyline.operators import usage as U
from tallyline.schemas import INVOICES
from tallyline.sources.json_lines import json_lines

# The sample invoices.
SAMPLE = [
    ("INV-1001", "Acme Corp", "2025-03-04", 12500, "PAID"),
    ("INV-1002", "Acme Corp", "2025-03-19", 4800, "UNPAID"),
    ("INV-1003", "Globex Inc", "2025-03-22", 9200, "UNPAID"),
    ("INV-1004", "Acme Corp", "2025-04-02", 3100, "PAID"),
    ("INV-1005", "Initech", "2025-04-11", 15750, "OVERDUE"),
    ("INV-1006", "Globex Inc", "2025-04-18", 6400, "PAID"),
]


@pytest.fixture(scope="module")
def invoices(spark):
    rows = [(i, c, datetime.date.fromisoformat(d), decimal.Decimal(a), s) for i, c, d, a, s in SAMPLE]
    return spark.createDataFrame(rows, INVOICES)


def test_totals(invoices):
    totals = {r["customer_name"]: (r["count"], r["total_amount"]) for r in I.customer_totals(invoices).collect()}
    assert totals["Acme Corp"] == (3, 20400) and totals["Globex Inc"] == (2, 15600)


def test_range(spark, invoices):
    asked = [
        (1, "Acme Corp", "2025-03-01", "2025-03-31"),
        (2, "Acme Corp", None, ""),
        (3, "Nobody", None, None),
        (4, "Globex Inc", "2025-04-18", None),
        (5, "Globex Inc", None, "2025-03-22"),
        (6, "Globex Inc", "2025-04-30", "2025-03-01"),
        (7, "Acme Corp", "2025-03-01", "2025-03-31"),
    ]
    requests = spark.createDataFrame(asked, "request_id INT, customer_name STRING, start_date STRING, end_date STRING")
    found = {r["request_id"]: (r["count"], r["total_amount"]) for r in I.range_lookup(requests, invoices).collect()}
    assert found == {1: (2, 17300), 2: (3, 20400), 3: (0, 0), 4: (1, 6400), 5: (1, 9200), 6: (0, 0), 7: (2, 17300)}
    rows = I.range_lookup_rows(requests, invoices).groupBy("request_id").agg(F.sort_array(F.collect_list("invoice_id")))
    assert {r[0]: r[1] for r in rows.collect()} == {
        1: ["INV-1001", "INV-1002"],
        2: ["INV-1001", "INV-1002", "INV-1004"],
        4: ["INV-1006"],
        5: ["INV-1003"],
        7: ["INV-1001", "INV-1002"],
    }


def test_undated_invoices_are_not_in_the_customer_index(spark, invoices):
    extra = spark.createDataFrame([("X", "Acme Corp", None, None, "PAID"), ("Y", None, None, None, "PAID")], INVOICES)
    both = invoices.unionByName(extra)
    assert I.filter_invoices(both, "Acme Corp").count() == 3
    assert [r["invoice_id"] for r in I.recent_invoices(both, 8).collect()][-2:] == ["X", "Y"]


def test_missing_amount_counts_as_zero(spark, invoices):
    extra = spark.createDataFrame([("X", "Initech", datetime.date(2025, 1, 1), None, "PAID")], INVOICES)
    totals = I.customer_totals(invoices.unionByName(extra)).filter("customer_name = 'Initech'").first()
    assert (totals["count"], totals["total_amount"]) == (2, 15750)


def test_recent_and_lookup(spark, invoices):
    assert [r["invoice_id"] for r in I.recent_invoices(invoices, 2).collect()] == ["INV-1006", "INV-1005"]
    asked = spark.createDataFrame([("INV-1003",), ("INV-9999",)], "invoice_id STRING")
    found = {r["invoice_id"]: (r["found"], r["amount"]) for r in I.lookup_by_key(asked, invoices, "invoice_id").collect()}
    assert found == {"INV-1003": (True, 9200), "INV-9999": (False, None)}
    assert [r[0] for r in I.customer_history(invoices, "Acme Corp").collect()] == ["INV-1001", "INV-1002", "INV-1004"]


def test_order_status(spark):
    ids = spark.createDataFrame([("A1002",), ("B7",)], "order_id STRING")
    texts = {r["order_id"]: r["message"] for r in AP.status_lookup(ids, AP.status_table(spark)).collect()}
    assert texts == {"A1002": "processing — leaves the warehouse today", "B7": "No order found with ID B7."}


def test_cost_and_remaining(spark):
    at = datetime.datetime(2025, 5, 1)
    row = spark.createDataFrame([("u", "r", at, at, 12, 240)], "user_id STRING, request_id STRING, started TIMESTAMP, ended TIMESTAMP, tokens_in INT, tokens_out INT")
    record = U.usage_records(row, "m").first()
    assert (record["cost_usd"], record["total_tokens"], record["period"]) == (0.00097, 252, "2025-05")
    decided = U.budget_admission(row.withColumnRenamed("started", "ts"), 100_000).first()
    assert (decided["accepted"], decided["remaining"]) == (True, 99748)


def test_second_prompt_over_the_limit(spark):
    rows = [("u", "1", datetime.datetime(2025, 5, 1), 12, 240), ("u", "2", datetime.datetime(2025, 5, 2), 5, 5)]
    asked = spark.createDataFrame(rows, "user_id STRING, request_id STRING, ts TIMESTAMP, tokens_in INT, tokens_out INT")
    first, second = U.budget_admission(asked, 200).orderBy("request_id").collect()
    assert (first["accepted"], first["remaining"]) == (True, 0)
    assert (second["accepted"], second["code"], second["message"]) == (
        False,
        429,
        "Monthly token limit reached (252/200).",
    )


def test_decisions(spark):
    at = datetime.datetime(2025, 5, 1)
    urls = [
        "https://h/approve?cb=a&decision=approve",
        "https://h/approve?cb=b&decision=Approve",
        "https://h/approve?cb=c",
        "https://h/approve?cb=&decision=approve",
        "https://h/approve?decision=approve",
        "https://h/approve?cb=d%2F1&decision=",
        "https://h/approve",
        "not a url",
    ]
    log = spark.createDataFrame([(u, at) for u in urls], "url STRING, ts TIMESTAMP")
    good, rejects = AP.decision_log(log)
    assert {r["cb"]: (r["decision"], r["status"]) for r in good.collect()} == {
        "a": ("approve", "APPROVED"),
        "b": ("Approve", "REJECTED"),
        "c": ("reject", "REJECTED"),
        "d/1": ("", "REJECTED"),
    }
    assert rejects.count() == 4 and {r["code"] for r in rejects.collect()} == {400}


def test_tool_calls(spark):
    calls = [
        ("t___get_invoice_by_id", '{"arguments": {"invoice_id": "1"}}'),
        (None, '{"tool_name": "get_invoice_by_id", "invoice_id": "1"}'),
        ("", '{"tool_name": "", "toolName": "t___get_invoice_by_id", "arguments": {}}'),
        ("", '{"toolName": "a____get_invoice_by_id", "invoice_id": "1"}'),
        (None, '{"invoice_id": "1"}'),
        ("list_recent_invoices", "broken"),
        ("get_invoices_by_customer", '{"arguments": "{", "customer_name": "c"}'),
    ]
    table = spark.createDataFrame(calls, "context_name STRING, event STRING")
    found = {(r["tool"], r["outcome"]): r["calls"] for r in I.tool_call_audit(table, I.tool_table(spark)).collect()}
    assert found == {
        ("get_invoice_by_id", "ok"): 2,
        ("get_invoice_by_id", "missing required argument"): 1,
        ("_get_invoice_by_id", "unknown tool"): 1,
        (None, "unknown tool"): 1,
        ("list_recent_invoices", "ok"): 1,
        ("get_invoices_by_customer", "ok"): 1,
    }


def test_notices(spark):
    orders = spark.createDataFrame(
        [("1", "cb1", "Lamp", decimal.Decimal("10.50"), ""), ("2", "cb2", "Desk", decimal.Decimal("99.00"), "a@b")],
        "order_id STRING, cb STRING, item STRING, amount DECIMAL(18,2), customer_email STRING",
    )
    first, second = AP.approval_notices(orders, "https://h/approve", "me@x").orderBy("order_id").collect()
    assert first["recipient"] == "me@x" and second["recipient"] == "a@b"
    assert first["approve_url"] == "https://h/approve?cb=cb1&decision=approve"
    assert first["subject"] == "Approve order 1?"
    assert "<b>Lamp</b> for $10.5." in first["body"] and first["reject_url"] in first["body"]


@pytest.mark.parametrize(("amount", "shown"), [("10", "10"), ("10.50", "10.5"), ("0", "0"), ("0.00", "0"), ("12345678.90", "12345678.9")])
def test_amounts_are_printed_as_given(spark, amount, shown):
    order = spark.createDataFrame(
        [("1", "cb1", "Lamp", decimal.Decimal(amount), "")],
        "order_id STRING, cb STRING, item STRING, amount DECIMAL(18,2), customer_email STRING",
    )
    assert f"for ${shown}.</p>" in AP.approval_notices(order, "u", "me@x").first()["body"]
    nested = order.select(F.array(F.struct("amount")).alias("list"), F.create_map(F.lit("k"), "amount").alias("map"))
    assert json_lines(nested).first()["value"] == f'{{"list":[{{"amount":{shown}}}],"map":{{"k":{shown}}}}}'


def test_a_bad_date_fails_one_request(spark):
    invoices = spark.createDataFrame(
        [("1", "c", datetime.date(2025, 1, 5), decimal.Decimal("2.50"), "PAID")],
        "invoice_id STRING, customer_name STRING, invoice_date DATE, amount DECIMAL(18,2), status STRING",
    )
    asked = spark.createDataFrame(
        [(1, "c", "2025-01-01", ""), (2, "c", "bad", None), (3, "c", None, "2025-13-01")],
        "request_id INT, customer_name STRING, start_date STRING, end_date STRING",
    )
    rows = {r["request_id"]: (r["count"], r["error"]) for r in I.range_lookup(asked, invoices).collect()}
    assert rows == {1: (1, None), 2: (None, "start_date is no date: bad"), 3: (None, "end_date is no date: 2025-13-01")}
    assert [r["request_id"] for r in I.range_lookup_rows(asked, invoices).collect()] == [1]


def test_a_change_wins_over_an_equal_base_row(spark):
    rows = [spark.createDataFrame([("k", 1, v)], "key STRING, at INT, value STRING") for v in ("z base", "a change")]
    assert K.keyed_put(*rows, ["key"], ["at"]).first()["value"] == "a change"
