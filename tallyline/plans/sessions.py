"""Queries of session lifecycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import lifecycle as L
from tallyline.plans import views as V
from tallyline.plans.common import plain


def idle_lifecycle(spark, sf):
    return plain(L.idle_lifecycle(V.session_requests(spark, sf)))


def idle_lifecycle_hours(spark, sf):
    """Six hours warm, eighteen more resumable, with sessions cut into 40 ranges."""
    return plain(
        L.idle_lifecycle(V.session_requests(spark, sf), 6 * 3600, 18 * 3600, parts=40)
    )


def registry_inputs_from(events):
    """Errors as failures of a session's resource, all other events as assignments of one."""
    events = events.select(
        F.col("user_id").alias("session_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("resource"),
        "event_type",
    )
    return events.filter("event_type <> 'error'").drop("event_type"), events.filter("event_type = 'error'")


def registry_inputs(spark, sf):
    return registry_inputs_from(V.table(spark, sf, "events"))


def session_registry(spark, sf):
    return plain(L.session_registry(*registry_inputs(spark, sf)))


def session_registry_sliced(spark, sf):
    return plain(L.session_registry(*registry_inputs(spark, sf), parts=40))


def session_rollup(spark, sf):
    return plain(L.session_rollup(V.spans(spark, sf)))


def span_rollup(spark, sf):
    """Events as spans with missing sessions, requests and actors, and attributes that conflict."""
    no = F.col("event_id")
    attributes = F.map_from_arrays(
        F.array(F.lit("kind"), F.col("event_type"), F.lit("agent.name")),
        F.array(F.when(no % 3 != 0, F.col("event_type")), no.cast("string"), F.lit("own")),
    )
    spans = V.table(spark, sf, "events").select(
        F.when(no % 10 != 0, F.col("user_id")).alias("session_id"),
        F.when(no % 7 != 0, F.expr("event_id div 4")).alias("request_id"),
        F.when(F.col("user_id") % 9 != 0, F.concat(F.lit("a"), F.col("user_id") % 20)).alias("actor_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        attributes.alias("attributes"),
    )
    found = L.session_rollup(L.with_span_defaults(spans))
    listed = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return plain(found.withColumn("attributes", F.array_join(listed, ";")))


def lifecycle_sql(idle: int, suspended: int) -> str:
    warm, resumed = idle * 1_000_000, (idle + suspended) * 1_000_000
    return f"""WITH gaps AS (
  SELECT user_id AS session_id, event_id AS request_id, ts,
         epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events),
states AS (
  SELECT *, CASE WHEN gap <= {warm} THEN 'warm' WHEN gap <= {resumed} THEN 'resumed'
       ELSE 'new' END AS state FROM gaps)
SELECT session_id, request_id, ts, gap / 1000000 AS gap_seconds, state,
       cast(sum(CASE WHEN state = 'new' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY ts, request_id
            ROWS UNBOUNDED PRECEDING) AS bigint) AS instance
FROM states"""


REGISTRY_SQL = """WITH e AS (
  SELECT user_id AS session_id, ts, event_id AS resource, event_type = 'error' AS failed,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts
             ROWS UNBOUNDED PRECEDING) AS epoch FROM events)
SELECT session_id, cast(epoch AS bigint) AS epoch, min_by(resource, ts) AS resource, min(ts) AS since
FROM e WHERE NOT failed GROUP BY session_id, epoch"""

_SPANS_SQL = """WITH spans AS (
  SELECT coalesce(cast(CASE WHEN event_id % 10 <> 0 THEN user_id END AS varchar), 'no-session') AS session_id,
         coalesce(cast(CASE WHEN event_id % 7 <> 0 THEN event_id // 4 END AS varchar), 'no-request') AS request_id,
         CASE WHEN user_id % 9 <> 0 THEN concat('a', user_id % 20) ELSE 'anonymous' END AS actor_id,
         ts, event_type, event_id FROM events),
said AS (
  SELECT session_id, request_id, ts, unnest([
    {'k': 'kind', 'v': CASE WHEN event_id % 3 <> 0 THEN event_type END}, {'k': event_type, 'v': cast(event_id AS varchar)},
    {'k': 'session.id', 'v': session_id}, {'k': 'request.id', 'v': request_id}, {'k': 'actor.id', 'v': actor_id},
    {'k': 'agent.name', 'v': 'support-agent'}, {'k': 'agent.version', 'v': '1.0.0'}], recursive := true)
  FROM spans),
merged AS (
  SELECT session_id, string_agg(k || '=' || v, ';' ORDER BY k) AS attributes
  FROM (SELECT session_id, k, v FROM said WHERE v IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY session_id, k ORDER BY ts DESC, request_id DESC, v DESC) = 1)
  GROUP BY session_id)
SELECT s.session_id, count(*) AS turns, count(DISTINCT request_id) AS requests, min(actor_id) AS actor_id,
       min(ts) AS first_ts, max(ts) AS last_ts, any_value(attributes) AS attributes
FROM spans s JOIN merged m ON m.session_id = s.session_id GROUP BY s.session_id"""

QUERIES = {
    "span_rollup": (span_rollup, _SPANS_SQL),
    "idle_lifecycle": (idle_lifecycle, lifecycle_sql(300, 1800)),
    "idle_lifecycle_hours": (idle_lifecycle_hours, lifecycle_sql(6 * 3600, 18 * 3600)),
    "session_registry": (session_registry, REGISTRY_SQL),
    "session_registry_sliced": (session_registry_sliced, REGISTRY_SQL),
    "session_rollup": (
        session_rollup,
        """SELECT conv_id AS session_id, count(*) AS turns, count(DISTINCT turn // 2) AS requests,
       min(CASE WHEN conv_id % 9 <> 0 THEN concat('a', conv_id % 20) END) AS actor_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(min(turn)) AS first_ts,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(max(turn)) AS last_ts
FROM conversations GROUP BY conv_id""",
    ),
}
