"""Queries that run a stream over a whole table, and the usage lake.

Each starts its stream with the available input, waits for its end and returns what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans import views as V
from tallyline.plans.commerce import order_decisions_sql
from tallyline.plans.common import USAGE_MONTHS_SQL, USAGE_SQL, plain, work_dir
from tallyline.plans.content import BATCHES_SQL, WORDS_SQL
from tallyline.plans.metering import LIMIT, admission_sql
from tallyline.plans.sessions import REGISTRY_SQL, registry_inputs_from
from tallyline.sources.usage_lake import parse_usage, read_usage_errors, read_usage_lake
from tallyline.sources.usage_lake import usage_ingest as ingest
from tallyline.streaming import answers as SA
from tallyline.streaming import approvals as SP
from tallyline.streaming import sessions as SS
from tallyline.streaming import usage as SU

NOW = {"availableNow": True}
FROM_DT, TO_DT = "2024-01-10", "2024-01-20"
GAP, DELAY = "6 hours", "1 hour"
BATCHES = 3


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a stream. The pattern matches the table alone, be it file or folder."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")


def in_batches(rows: DataFrame, path: str, batches: int = BATCHES, ts: str = "ts") -> DataFrame:
    """A table as a stream of `batches` micro-batches in the order of time, one file each.

    The bounds are quantiles of all rows; rows without a time come first. This is a feed for
    queries that must see state across batches: each file is written by one task.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = [k / batches for k in range(1, batches)]
    bounds = rows.agg(F.percentile_approx(at, shares, 1000)).first()[0] or []
    number = F.lit(0)
    for bound in bounds:
        number = number + F.coalesce((at > bound).cast("int"), F.lit(0))
    for k in range(batches):
        rows.filter(number == k).coalesce(1).write.parquet(f"{path}/batch={k}")
    source = rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    return source.parquet(f"{path}/batch=*")


def _cores(spark) -> int:
    return spark.sparkContext.defaultParallelism


def _requests_in_batches(spark, sf, home) -> DataFrame:
    """The requests of all months in the order of their time, in several batches."""
    return in_batches(V.requests_from(V.table(spark, sf, "events"), months=True), f"{home}/in")


def stream_usage_counters(spark, sf):
    home = work_dir(spark, "counters")
    SU.stream_usage_counters(
        _requests_in_batches(spark, sf, home), f"{home}/table", f"{home}/checkpoint"
    ).awaitTermination()
    return plain(SU.read_counters(spark, f"{home}/table"))


def stream_budget_admission(spark, sf):
    home = work_dir(spark, "admission")
    SU.stream_budget_admission(
        _requests_in_batches(spark, sf, home), LIMIT, f"{home}/decisions", f"{home}/counters", f"{home}/checkpoint"
    ).awaitTermination()
    return plain(spark.read.parquet(f"{home}/decisions").drop("batch_id"))


def stream_order_decisions(spark, sf):
    home = work_dir(spark, "orders")
    orders = V.submissions_from(stream(spark, sf, "orders"))
    decisions = V.decisions_from(stream(spark, sf, "lineitem"))
    SP.stream_order_decisions(
        orders, decisions, f"{home}/table", f"{home}/checkpoint", partitions=_cores(spark)
    ).awaitTermination()
    status = SP.read_order_status(spark, f"{home}/table", V.submissions(spark, sf))
    return plain(status.drop("timed_out"))


def stream_sessions(spark, sf):
    home = work_dir(spark, "sessions")
    requests = V.session_requests_from(stream(spark, sf, "events"))
    SS.stream_sessions(
        requests, GAP, DELAY, f"{home}/closed", f"{home}/checkpoint", partitions=_cores(spark)
    ).awaitTermination()
    return plain(spark.read.parquet(f"{home}/closed"))


def stream_session_registry(spark, sf):
    """Assignments and failures as two streams, in several batches."""
    home = work_dir(spark, "registry")
    events = in_batches(V.table(spark, sf, "events"), f"{home}/in")
    SS.stream_session_registry(
        *registry_inputs_from(events), f"{home}/table", f"{home}/checkpoint", partitions=_cores(spark)
    ).awaitTermination()
    return plain(SS.read_registry(spark, f"{home}/table"))


def _lines(spark, sf):
    return V.usage_lines_from(V.requests_from(stream(spark, sf, "events")))


def _lake(spark, sf) -> str:
    home = work_dir(spark, "lake")
    SU.stream_usage_lake(_lines(spark, sf), f"{home}/usage", f"{home}/checkpoint", trigger=NOW).awaitTermination()
    return f"{home}/usage"


def stream_usage_lake(spark, sf):
    return plain(read_usage_lake(spark, _lake(spark, sf)))


def stream_usage_lake_errors(spark, sf):
    return read_usage_errors(spark, _lake(spark, sf))


def _ingested(spark, sf) -> str:
    path = f"{work_dir(spark, 'ingest')}/usage"
    ingest(V.usage_lines(spark, sf), path)
    return path


def usage_ingest(spark, sf):
    return plain(read_usage_lake(spark, _ingested(spark, sf)))


def usage_ingest_errors(spark, sf):
    return read_usage_errors(spark, _ingested(spark, sf))


def usage_lake_write(spark, sf):
    home = work_dir(spark, "lake-sink")
    SU.usage_lake_write(
        parse_usage(_lines(spark, sf)), f"{home}/usage", f"{home}/checkpoint", trigger=NOW
    ).awaitTermination()
    return plain(read_usage_lake(spark, f"{home}/usage"))


def usage_lake_read(spark, sf):
    return plain(read_usage_lake(spark, _ingested(spark, sf), FROM_DT, TO_DT))


def _assembled(spark, sf) -> str:
    home = work_dir(spark, "assembly")
    events = V.model_events_from(stream(spark, sf, "conversations")).withColumn("ts", V.event_time())
    SA.stream_text_assembly(
        events, f"{home}/answers", f"{home}/batches", f"{home}/pending", f"{home}/checkpoint"
    ).awaitTermination()
    return home


def stream_text_assembly(spark, sf):
    return plain(spark.read.parquet(f"{_assembled(spark, sf)}/answers").drop("batch_id"))


def stream_text_batches(spark, sf):
    batches = spark.read.parquet(f"{_assembled(spark, sf)}/batches")
    return plain(batches.select("request_id", "batch", F.array_join("texts", "|").alias("texts")))


_LAKE_SQL = f"""WITH {USAGE_SQL}
SELECT user_id, request_id, 'm' AS model_id, tokens_in, tokens_out, tokens_in + tokens_out AS total_tokens,
       cast(NULL AS double) AS cost_usd, cast(NULL AS bigint) AS latency_ms, ts, cast(ts AS date) AS dt
FROM usage WHERE cast(request_id AS bigint) % 97 <> 0 AND cast(request_id AS bigint) % 89 <> 0"""
_ERRORS_SQL = """SELECT CASE WHEN event_id % 97 = 0 THEN concat('broken ', event_id)
       ELSE concat('{"request_id":"', event_id, '","tokens_in":"many"}') END AS value
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0"""

QUERIES = {
    "usage_ingest": (usage_ingest, _LAKE_SQL),
    "usage_ingest_errors": (usage_ingest_errors, _ERRORS_SQL),
    "usage_lake_write": (usage_lake_write, _LAKE_SQL),
    "usage_lake_read": (
        usage_lake_read,
        f"{_LAKE_SQL} AND cast(ts AS date) BETWEEN DATE '{FROM_DT}' AND DATE '{TO_DT}'",
    ),
    "stream_usage_lake": (stream_usage_lake, _LAKE_SQL),
    "stream_usage_lake_errors": (stream_usage_lake_errors, _ERRORS_SQL),
    "stream_usage_counters": (
        stream_usage_counters,
        f"""WITH {USAGE_MONTHS_SQL}
SELECT user_id, strftime(ts, '%Y-%m') AS period, cast(sum(tokens_in + tokens_out) AS bigint) AS total_tokens,
       cast(sum(tokens_in) AS bigint) AS tokens_in, cast(sum(tokens_out) AS bigint) AS tokens_out,
       count(*) AS requests, min(ts) + INTERVAL 90 DAY AS expires_at
FROM usage GROUP BY user_id, strftime(ts, '%Y-%m')""",
    ),
    "stream_budget_admission": (
        stream_budget_admission,
        f"WITH {admission_sql(USAGE_MONTHS_SQL)} SELECT * FROM decided",
    ),
    "stream_order_decisions": (stream_order_decisions, order_decisions_sql(2, flags=False)),
    "stream_sessions": (
        stream_sessions,
        """WITH gaps AS (
  SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR AS opens FROM events),
numbered AS (
  SELECT user_id, ts, sum(CASE WHEN opens THEN 1 ELSE 0 END)
         OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM gaps),
sessions AS (
  SELECT user_id AS session_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS requests
  FROM numbered GROUP BY user_id, no)
SELECT * FROM sessions
WHERE "end" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""",
    ),
    "stream_session_registry": (stream_session_registry, REGISTRY_SQL),
    "stream_text_assembly": (
        stream_text_assembly,
        f"""WITH {WORDS_SQL}, n AS (SELECT request_id, count(*) AS deltas FROM deltas GROUP BY request_id)
SELECT t.request_id, true AS complete, t.text AS answer, n.deltas, len(words) AS tokens_in,
       CASE WHEN turn % 2 = 1 THEN len(words) * 2 ELSE 0 END AS tokens_out
FROM turns t JOIN n ON n.request_id = t.request_id""",
    ),
    "stream_text_batches": (stream_text_batches, BATCHES_SQL),
}
