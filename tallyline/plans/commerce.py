"""Queries of invoices, approvals and tool calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import approvals as AP
from tallyline.operators import invoices as I
from tallyline.operators.keyed import keyed_merge as merge
from tallyline.operators.keyed import keyed_put as put
from tallyline.plans import views as V
from tallyline.plans.common import INVOICES_SQL, plain, work_dir
from tallyline.sources.invoice_table import read_invoices, write_invoices
from tallyline.sources.json_lines import json_lines

START, END = "1996-03-15", "1999-08-20"
AS_OF = "1999-06-01 00:00:00"


def keyed_put(spark, sf):
    """Events as writes to one row per user: purchases and errors written over the others."""
    events = V.table(spark, sf, "events")
    late = F.col("event_type").isin("purchase", "error")
    return put(events.filter(~late), events.filter(late), ["user_id"], ["event_id"])


def keyed_merge(spark, sf):
    """A row per user from signups; every other event changes it, errors of low value delete it."""
    events = V.table(spark, sf, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    base = events.filter("event_type = 'signup'").groupBy("user_id").agg(
        F.max_by("event_type", "event_id").alias("state"),
        F.sum("cents").alias("cents"),
        F.min(F.when(F.col("value") > 20, F.col("ts"))).alias("first_ts"),
        F.count(F.lit(1)).alias("signups"),
    )
    changes = events.filter("event_type <> 'signup'").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("state"),
        "cents",
        F.col("ts").alias("first_ts"),
        ((F.col("event_type") == "error") & (F.col("value") < 1)).alias("gone"),
    )
    return plain(
        merge(
            base, changes, ["user_id"], ["event_id"], set=["state"], add=["cents"],
            set_if_absent=["first_ts"], delete_flag="gone",
        )
    )


def lookup_by_key(spark, sf):
    return plain(I.lookup_by_key(V.id_requests(spark, sf), V.invoices(spark, sf), "invoice_id"))


def range_lookup(spark, sf):
    return plain(I.range_lookup(V.range_requests(spark, sf), V.invoices(spark, sf)))


def range_lookup_rows(spark, sf):
    return plain(I.range_lookup_rows(V.range_requests(spark, sf), V.invoices(spark, sf)))


def filter_invoices(spark, sf):
    return plain(I.filter_invoices(V.invoices(spark, sf), None, START, END))


def customer_totals(spark, sf):
    return plain(I.customer_totals(V.invoices(spark, sf), START, END))


def _statements(spark, sf, **options):
    pages = I.customer_statements(V.invoices(spark, sf), START, None, page_rows=4, **options)
    ids = F.array_join(F.transform("invoices", lambda i: i["invoice_id"].cast("string")), ",")
    return plain(pages.withColumn("invoices", ids))


def customer_statements(spark, sf):
    return _statements(spark, sf)


def customer_statements_sliced(spark, sf):
    return _statements(spark, sf, parts=300)


def recent_invoices(spark, sf):
    return plain(I.recent_invoices(V.invoices(spark, sf)))


def customer_history(spark, sf):
    return plain(I.customer_history(V.invoices(spark, sf), 7))


def export_json(spark, sf):
    return json_lines(V.invoices(spark, sf).select("invoice_id", "amount", "status"))


def _tool_calls(spark, sf):
    return V.table(spark, sf, "events").select(
        F.expr(_CONTEXT_NAME).alias("context_name"),
        F.expr(_CALL).alias("event"),
    )


_CONTEXT_NAME = "CASE WHEN event_id % 5 = 0 THEN 'tools___get_invoice_by_id' WHEN event_id % 5 = 1 THEN '' END"
# One call as JSON text, in SQL both engines read: three ways to name the tool, arguments
# nested or beside the name, sometimes missing.
_CALL = """concat('{"', CASE WHEN event_id % 2 = 0 THEN 'tool_name' ELSE 'toolName' END, '":"',
  CASE event_type WHEN 'view' THEN 'x___get_invoice_by_id' WHEN 'click' THEN 'get_invoices_by_customer'
       WHEN 'error' THEN 'x___list_recent_invoices' WHEN 'signup' THEN '' ELSE 'x___drop_table' END, '"',
  CASE event_id % 4 WHEN 0 THEN ',"arguments":{"invoice_id":"1"}' WHEN 1 THEN ',"arguments":{"customer_name":"c"}'
       WHEN 2 THEN ',"invoice_id":"1","customer_name":"c"' ELSE ',"arguments":"none"' END, '}')"""


def tool_call_audit(spark, sf):
    return I.tool_call_audit(_tool_calls(spark, sf), I.tool_table(spark))


def approval_notices(spark, sf):
    return AP.approval_notices(V.notices(spark, sf), "https://h/p/approve", "ops@x")


def decision_log(spark, sf):
    return plain(AP.decision_log(V.decision_urls(spark, sf))[0])


def decision_rejects(spark, sf):
    return plain(AP.decision_log(V.decision_urls(spark, sf))[1])


def first_decision(spark, sf):
    return plain(AP.first_decision(V.decisions(spark, sf), ["cb"], ["ts", "line"]))


def _order_decisions(spark, sf, **options):
    as_of = F.lit(AS_OF).cast("timestamp")
    return plain(
        AP.order_decisions(V.submissions(spark, sf), V.decisions(spark, sf), as_of, tie="line", **options)
    )


def order_decisions(spark, sf):
    return _order_decisions(spark, sf)


def order_decisions_30_days(spark, sf):
    return _order_decisions(spark, sf, wait_days=30, hot_rows=6)


def order_approval(spark, sf):
    """The whole workflow: orders stored as pending, the approval log stored as decisions and
    matched to them within the waiting time, and the status of the decided ones set."""
    orders = V.submissions(spark, sf)
    stored = orders.withColumn("status", F.lit(AP.PENDING))
    path = work_dir(spark, "decisions")
    log = AP.decision_log(V.decision_urls(spark, sf))[0]
    cb, line = F.col("cb").cast("bigint").alias("cb"), F.col("l_linenumber").alias("line")
    log.select(cb, "ts", line, "decision").write.parquet(path)
    as_of = F.lit(AS_OF).cast("timestamp")
    decided = AP.order_decisions(orders, spark.read.parquet(path), as_of, wait_days=60, tie="line")
    changes = decided.filter("decided_at IS NOT NULL").select("order_id", "decided_at", "status")
    return plain(merge(stored, changes, ["order_id"], ["decided_at"], set=["status"]))


def stored_history(spark, sf):
    """The invoices written in customer and date order, and one customer read back."""
    path = f"{work_dir(spark, 'invoices')}/table"
    invoices = V.invoices(spark, sf)
    write_invoices(invoices, path)
    return plain(I.customer_history(read_invoices(spark, path, invoices.schema), 7))


def status_lookup(spark, sf):
    ids = V.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("A100"), (F.col("event_id") % 6).cast("string")).alias("order_id")
    )
    return AP.status_lookup(ids, AP.status_table(spark))


_CB = "CASE WHEN l_orderkey % 7 = 0 OR l_orderkey % 13 = 0 THEN NULL ELSE cast(l_orderkey AS varchar) END"
_WORD = """CASE WHEN l_orderkey % 11 = 0 THEN 'reject' WHEN l_returnflag = 'A' THEN 'approve'
     WHEN l_returnflag = 'R' THEN 'reject' ELSE 'Approve' END"""
_URL = """concat('https://h/p/approve?', CASE WHEN l_orderkey % 7 = 0 THEN 'x=1' WHEN l_orderkey % 13 = 0 THEN 'cb='
  ELSE concat('cb=', l_orderkey) END, CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE concat('&decision=',
  CASE WHEN l_returnflag = 'A' THEN 'approve' WHEN l_returnflag = 'R' THEN 'reject' ELSE 'Approve' END) END)"""

_RANGES_SQL = """req AS (
  SELECT c_custkey AS request_id, c_custkey AS customer_name,
         CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '1996-03-15' END END AS start_date,
         CASE WHEN c_custkey % 4 <> 0 THEN '1999-08-20' END AS end_date
  FROM customer), hits AS (
  SELECT r.*, i.invoice_id, i.invoice_date, i.amount, i.status FROM req r JOIN invoices i
  ON i.customer_name = r.customer_name
  AND i.invoice_date >= coalesce(cast(nullif(r.start_date, '') AS date), i.invoice_date)
  AND i.invoice_date <= coalesce(cast(nullif(r.end_date, '') AS date), i.invoice_date))"""

_DECISIONS_SQL = """dec AS (
  SELECT l_orderkey AS cb, l_shipdate AS ts, cast(l_linenumber AS bigint) AS line,
         CASE l_returnflag WHEN 'A' THEN 'approve' WHEN 'R' THEN 'reject' ELSE 'other' END AS decision
  FROM lineitem)"""


def order_decisions_sql(days: int, flags: bool = True) -> str:
    extra = f", d.ts IS NULL AND TIMESTAMP '{AS_OF}' > o.o_orderdate + INTERVAL {days} DAY AS timed_out"
    return f"""WITH {_DECISIONS_SQL}, hit AS (
  SELECT o.o_orderkey, d.* FROM orders o JOIN dec d
  ON d.cb = o.o_orderkey AND d.ts >= o.o_orderdate AND d.ts <= o.o_orderdate + INTERVAL {days} DAY
  QUALIFY row_number() OVER (PARTITION BY o.o_orderkey ORDER BY d.ts, d.line, d.decision) = 1)
SELECT o.o_orderkey AS order_id, o.o_orderdate AS submitted, d.ts AS decided_at{', d.decision' if flags else ''},
       CASE WHEN d.ts IS NULL THEN 'PENDING_APPROVAL' WHEN d.decision = 'approve' THEN 'APPROVED'
            ELSE 'REJECTED' END AS status{extra if flags else ''}
FROM orders o LEFT JOIN hit d ON d.o_orderkey = o.o_orderkey"""


_STATEMENTS_SQL = f"""WITH {INVOICES_SQL}, placed AS (
  SELECT *, (row_number() OVER (PARTITION BY customer_name ORDER BY invoice_date, invoice_id) - 1) // 4 AS page
  FROM invoices WHERE invoice_date >= DATE '{START}'), totals AS (
  SELECT customer_name, count(*) AS count, cast(sum(amount) AS double) AS total_amount FROM placed GROUP BY 1)
SELECT p.customer_name, p.page, string_agg(cast(invoice_id AS varchar), ',' ORDER BY invoice_date, invoice_id) AS invoices,
       any_value(t.count) AS count, any_value(t.total_amount) AS total_amount
FROM placed p JOIN totals t ON t.customer_name = p.customer_name GROUP BY p.customer_name, p.page"""
_INVOICE_COLUMNS = "invoice_id, customer_name, invoice_date, cast(amount AS double) AS amount, status"

QUERIES = {
    "keyed_put": (
        keyed_put,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    ),
    "keyed_merge": (
        keyed_merge,
        """WITH ev AS (SELECT *, cast(round(value * 100) AS bigint) AS cents,
       event_type = 'error' AND value < 1 AS gone FROM events),
base AS (SELECT user_id, 'signup' AS state, sum(cents) AS cents, min(ts) FILTER (value > 20) AS first_ts,
       count(*) AS signups FROM ev WHERE event_type = 'signup' GROUP BY user_id),
deleted AS (SELECT user_id, max(event_id) AS at FROM ev WHERE gone GROUP BY user_id),
log AS (SELECT e.* FROM ev e LEFT JOIN deleted d ON d.user_id = e.user_id
       WHERE event_type <> 'signup' AND NOT gone AND (d.at IS NULL OR e.event_id > d.at)),
change AS (SELECT user_id, max_by(event_type, event_id) FILTER (event_type <> 'view') AS state,
       sum(cents) AS cents, min_by(ts, event_id) AS first_ts FROM log GROUP BY user_id),
kept AS (SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM deleted))
SELECT coalesce(k.user_id, c.user_id) AS user_id, coalesce(c.state, k.state) AS state,
       cast(coalesce(k.cents, 0) + coalesce(c.cents, 0) AS bigint) AS cents,
       coalesce(k.first_ts, c.first_ts) AS first_ts, k.signups
FROM kept k FULL JOIN change c ON c.user_id = k.user_id""",
    ),
    "lookup_by_key": (
        lookup_by_key,
        f"""WITH {INVOICES_SQL}
SELECT r.o_orderkey * 2 AS invoice_id, i.customer_name, i.invoice_date, cast(i.amount AS double) AS amount,
       i.status, i.invoice_id IS NOT NULL AS found
FROM orders r LEFT JOIN invoices i ON i.invoice_id = r.o_orderkey * 2""",
    ),
    "range_lookup": (
        range_lookup,
        f"""WITH {INVOICES_SQL}, {_RANGES_SQL}
SELECT r.request_id, r.customer_name, r.start_date, r.end_date, CAST(NULL AS VARCHAR) AS error, count(h.invoice_id) AS count,
       cast(coalesce(sum(h.amount), 0) AS double) AS total_amount
FROM req r LEFT JOIN hits h ON h.request_id = r.request_id GROUP BY ALL""",
    ),
    "range_lookup_rows": (
        range_lookup_rows,
        f"""WITH {INVOICES_SQL}, {_RANGES_SQL}
SELECT request_id, customer_name, start_date, end_date, invoice_id, invoice_date, cast(amount AS double) AS amount,
       status FROM hits""",
    ),
    "filter_invoices": (
        filter_invoices,
        f"""WITH {INVOICES_SQL}
SELECT {_INVOICE_COLUMNS} FROM invoices WHERE invoice_date BETWEEN DATE '{START}' AND DATE '{END}'""",
    ),
    "customer_totals": (
        customer_totals,
        f"""WITH {INVOICES_SQL}
SELECT customer_name, count(*) AS count, cast(sum(amount) AS double) AS total_amount
FROM invoices WHERE invoice_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY customer_name""",
    ),
    "customer_statements": (customer_statements, _STATEMENTS_SQL),
    "customer_statements_sliced": (customer_statements_sliced, _STATEMENTS_SQL),
    "recent_invoices": (
        recent_invoices,
        f"""WITH {INVOICES_SQL}
SELECT {_INVOICE_COLUMNS} FROM invoices ORDER BY invoice_date DESC, invoice_id LIMIT 10""",
    ),
    "customer_history": (
        customer_history,
        f"""WITH {INVOICES_SQL}
SELECT {_INVOICE_COLUMNS} FROM invoices WHERE customer_name = 7 ORDER BY invoice_date, invoice_id""",
    ),
    "stored_history": (
        stored_history,
        f"""WITH {INVOICES_SQL}
SELECT {_INVOICE_COLUMNS} FROM invoices WHERE customer_name = 7 ORDER BY invoice_date, invoice_id""",
    ),
    "order_approval": (
        order_approval,
        f"""WITH log AS (SELECT {_CB} AS cb, l_shipdate AS ts, l_linenumber AS line, {_WORD} AS decision FROM lineitem),
hit AS (
  SELECT o.o_orderkey, d.decision FROM orders o JOIN log d ON d.cb = cast(o.o_orderkey AS varchar)
  AND d.ts >= o.o_orderdate AND d.ts <= o.o_orderdate + INTERVAL 60 DAY
  QUALIFY row_number() OVER (PARTITION BY o.o_orderkey ORDER BY d.ts, d.line, d.decision) = 1)
SELECT o.o_orderkey AS order_id, o.o_orderdate AS submitted,
       CASE WHEN h.o_orderkey IS NULL THEN 'PENDING_APPROVAL' WHEN h.decision = 'approve' THEN 'APPROVED'
            ELSE 'REJECTED' END AS status
FROM orders o LEFT JOIN hit h ON h.o_orderkey = o.o_orderkey""",
    ),
    "export_json": (
        export_json,
        f"""WITH {INVOICES_SQL}
SELECT concat('{{"invoice_id":', invoice_id, ',"amount":',
  CASE WHEN amount % 1 = 0 THEN cast(cast(amount AS bigint) AS varchar) ELSE cast(cast(amount AS double) AS varchar) END,
  ',"status":"', status, '"}}') AS value FROM invoices""",
    ),
    "tool_call_audit": (
        tool_call_audit,
        f"""WITH calls AS (
  SELECT {_CONTEXT_NAME} AS context_name,
         {_CALL} AS event FROM events),
named AS (
  SELECT string_split(coalesce(nullif(context_name, ''), nullif(json_extract_string(event, '$.tool_name'), ''),
         nullif(json_extract_string(event, '$.toolName'), '')), '___')[-1] AS tool,
         CASE WHEN json_type(event, '$.arguments') = 'OBJECT' THEN json_extract(event, '$.arguments') ELSE cast(event AS json) END AS args
  FROM calls),
judged AS (
  SELECT tool, CASE tool WHEN 'get_invoice_by_id' THEN 'invoice_id' WHEN 'get_invoices_by_customer' THEN 'customer_name'
         WHEN 'list_recent_invoices' THEN '' END AS required, json_keys(args) AS given FROM named)
SELECT tool, CASE WHEN required IS NULL THEN 'unknown tool' WHEN required <> '' AND NOT list_contains(given, required)
       THEN 'missing required argument' ELSE 'ok' END AS outcome, count(*) AS calls FROM judged GROUP BY ALL""",
    ),
    "approval_notices": (
        approval_notices,
        """WITH n AS (SELECT *, concat('https://h/p/approve?cb=', o_orderkey, '&decision=') AS link FROM orders)
SELECT cast(o_orderkey AS varchar) AS order_id,
       CASE WHEN o_orderkey % 5 = 0 THEN 'ops@x' ELSE concat('c', o_custkey, '@x') END AS recipient,
       concat('Approve order ', o_orderkey, '?') AS subject, concat(link, 'approve') AS approve_url,
       concat(link, 'reject') AS reject_url,
       concat('<p>Order <b>', o_orderpriority, '</b> for $', regexp_replace(cast(cast(o_totalprice AS decimal(18,2)) AS varchar), '[.]?0+$', ''),
              '.</p><p><a href=''', link, 'approve''>✅ Approve</a>&nbsp;&nbsp;<a href=''', link,
              'reject''>❌ Reject</a></p>') AS body
FROM n""",
    ),
    "decision_log": (
        decision_log,
        f"""SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_shipdate AS ts, {_CB} AS cb, {_WORD} AS decision,
       CASE WHEN {_WORD} = 'approve' THEN 'APPROVED' ELSE 'REJECTED' END AS status
FROM lineitem WHERE {_CB} IS NOT NULL""",
    ),
    "decision_rejects": (
        decision_rejects,
        f"""SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_shipdate AS ts, {_URL} AS url, cast(400 AS bigint) AS code
FROM lineitem WHERE {_CB} IS NULL""",
    ),
    "first_decision": (
        first_decision,
        f"""WITH {_DECISIONS_SQL}
SELECT * FROM dec QUALIFY row_number() OVER (PARTITION BY cb ORDER BY ts, line, decision) = 1""",
    ),
    "order_decisions": (order_decisions, order_decisions_sql(2)),
    "order_decisions_30_days": (order_decisions_30_days, order_decisions_sql(30)),
    "status_lookup": (
        status_lookup,
        """SELECT event_id, concat('A100', event_id % 6) AS order_id,
       CASE event_id % 6 WHEN 1 THEN 'shipped — arriving tomorrow'
            WHEN 2 THEN 'processing — leaves the warehouse today' WHEN 3 THEN 'delivered on 2026-06-30'
            ELSE concat('No order found with ID A100', event_id % 6, '.') END AS message
FROM events""",
    ),
}
