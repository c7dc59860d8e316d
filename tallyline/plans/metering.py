"""Queries of the metering core."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import answers as A
from tallyline.operators import usage as U
from tallyline.plans import views as V
from tallyline.plans.common import USAGE_MONTHS_SQL, USAGE_SQL, plain, work_dir
from tallyline.schemas import USAGE
from tallyline.sources.usage_lake import read_usage_lake, usage_ingest

LIMIT = 3000
AS_OF = "2024-04-15 00:00:00"

FINISHED_SQL = f"""{USAGE_MONTHS_SQL}, finished AS (
  SELECT *, ts + to_microseconds(tokens_out * 10000) AS ended FROM usage)"""
RECORDS_SQL = f"""{FINISHED_SQL}, records AS (
  SELECT user_id, request_id, 'model-a' AS model_id, tokens_in, tokens_out,
         tokens_in + tokens_out AS total_tokens,
         round(tokens_in / 1000 * 0.0008 + tokens_out / 1000 * 0.004, 6) AS cost_usd,
         tokens_out * 10 AS latency_ms, ended AS ts, strftime(ended, '%Y-%m') AS period,
         cast(ended AS date) AS dt
  FROM finished)"""


def admission_sql(usage: str) -> str:
    """Admission over the whole history with plain windows, as CTEs ending in `decided`."""
    return f"""{usage}, running AS (
  SELECT *, strftime(ts, '%Y-%m') AS period, tokens_in + tokens_out AS tokens,
         coalesce(sum(tokens_in + tokens_out) OVER before, 0) AS earlier
  FROM usage
  WINDOW before AS (PARTITION BY user_id, strftime(ts, '%Y-%m') ORDER BY ts, request_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
frozen AS (
  SELECT user_id, period, min(earlier + tokens) AS total FROM running
  WHERE earlier + tokens >= {LIMIT} GROUP BY user_id, period),
decided AS (
  SELECT r.user_id, r.period, r.request_id, r.ts, r.tokens_in, r.tokens_out, r.earlier < {LIMIT} AS accepted,
         cast(CASE WHEN r.earlier < {LIMIT} THEN r.earlier ELSE f.total END AS bigint) AS used,
         cast(CASE WHEN r.earlier < {LIMIT} THEN greatest(0, {LIMIT} - r.earlier - r.tokens) END AS bigint) AS remaining,
         cast(CASE WHEN r.earlier >= {LIMIT} THEN 429 END AS bigint) AS code,
         CASE WHEN r.earlier >= {LIMIT}
              THEN concat('Monthly token limit reached (', f.total, '/{LIMIT}).') END AS message
  FROM running r LEFT JOIN frozen f ON r.user_id = f.user_id AND r.period = f.period)"""


def _records(spark, sf, months=True):
    return U.usage_records(V.finished(spark, sf, months), "model-a")


def _admission(spark, sf, **options):
    return U.budget_admission(V.requests(spark, sf, months=True), LIMIT, **options)


def usage_report(spark, sf):
    return plain(U.usage_report(_records(spark, sf)))


def usage_records(spark, sf):
    return plain(_records(spark, sf))


def usage_counters(spark, sf):
    return plain(U.usage_counters(_admission(spark, sf).filter("accepted")))


def budget_admission(spark, sf):
    return plain(_admission(spark, sf))


def budget_admission_sliced(spark, sf):
    return plain(_admission(spark, sf, parts=300))


def current_usage(spark, sf):
    counters = U.usage_counters(_records(spark, sf).filter("tokens_in >= 10"))
    return plain(U.current_usage(V.requests(spark, sf, months=True), counters))


def ttl_filter(spark, sf):
    """Counter rows written before the counter of their month expired."""
    rows = V.requests(spark, sf, months=True).withColumn("period", U.period_of("ts"))
    as_of = F.lit(AS_OF).cast("timestamp")
    return plain(U.ttl_filter(rows, as_of, 90, ["user_id", "period"]))


def ttl_filter_rows(spark, sf):
    """Memory events of the last seven days."""
    return plain(U.ttl_filter(V.requests(spark, sf), F.lit("2024-01-25 12:00:00").cast("timestamp"), 7))


def route_prompts(spark, sf):
    return plain(U.route_prompts(V.publishes(spark, sf))[0])


def route_passthrough(spark, sf):
    passed = U.route_prompts(V.publishes(spark, sf))[1]
    return passed.select("event_id", "path", "sub", F.size("events").cast("bigint").alias("events"))


def _bodies(spark, sf):
    """Events as request bodies: absent and empty fields, empty bodies, and broken JSON."""
    user = F.col("user_id").cast("string")
    no = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(no % 4 != 0, F.col("event_type")).alias("prompt"),
            F.when(no % 5 != 0, F.when(no % 10 == 1, "").otherwise(user)).alias("actor_id"),
            F.when(no % 3 != 0, F.when(no % 6 == 1, "").otherwise(F.concat(F.lit("s"), user))).alias("session_id"),
            F.when(no % 7 != 0, F.col("event_type")).alias("item"),
            F.when(no % 8 != 0, F.col("value")).alias("amount"),
            F.when(no % 9 != 0, F.concat(user, F.lit("@x"))).alias("customer_email"),
        )
    )
    return V.table(spark, sf, "events").select(
        "event_id", F.when(no % 97 == 0, "not json").when(no % 89 == 0, "").otherwise(body).alias("body")
    )


def normalize_chat(spark, sf):
    return U.normalize_requests(_bodies(spark, sf), "chat", key=["event_id"])[0]


def normalize_orders(spark, sf):
    return plain(U.normalize_requests(_bodies(spark, sf), "order", key=["event_id"])[0])


def normalize_rejects(spark, sf):
    return U.normalize_requests(_bodies(spark, sf), "chat", key=["event_id"])[1]


def _stored(spark, rows, label):
    """Rows that several steps read, written once."""
    path = work_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _asked(spark, sf):
    return _stored(spark, U.route_prompts(V.publishes(spark, sf))[0], "prompts")


def _model_events(asked):
    """The answer to a prompt repeats its words; its usage event counts the number in the
    prompt in and a part of the event id out."""
    words = F.split("prompt", " ")
    deltas = asked.select("prompt_id", F.posexplode(words).alias("seq", "text")).select(
        "prompt_id", "seq", F.struct(F.struct("text").alias("delta")).alias("contentBlockDelta")
    )
    tokens = F.struct(
        F.coalesce(F.get_json_object("prompt", "$.k").cast("int"), F.lit(0)).alias("inputTokens"),
        (F.col("event_id") % 50).cast("int").alias("outputTokens"),
    )
    usage = asked.select("prompt_id", F.size(words).alias("seq"), F.struct(tokens.alias("usage")).alias("metadata"))
    return deltas.unionByName(usage, allowMissingColumns=True)


def _decided(spark, prompts):
    asked = A.final_usage(prompts, _model_events(prompts), key="prompt_id")
    asked = asked.select("user_id", "request_id", "prompt_id", "ts", "tokens_in", "tokens_out")
    cost = U.cost_of(F.col("tokens_in"), F.col("tokens_out"), U.PRICE_IN_PER_1K, U.PRICE_OUT_PER_1K)
    decided = U.budget_admission(_stored(spark, asked, "asked"), LIMIT, key="prompt_id")
    return decided.withColumn("cost_usd", cost)


def out_events(spark, sf):
    """Tokens of the answers, errors and done events; decisions are stored before the feed reads them."""
    prompts = _asked(spark, sf)
    decided = _stored(spark, _decided(spark, prompts), "decided")
    deltas = A.text_deltas(_model_events(prompts))
    return plain(A.out_events(deltas, decided, key="prompt_id"))


def metered_chat(spark, sf):
    """The flagship: publishes are routed, answered, admitted by what their answers use, and
    recorded in the lake as JSON lines; the bill is read from the lake."""
    accepted = _decided(spark, _asked(spark, sf)).filter("accepted")
    records = U.usage_records(
        accepted.withColumnRenamed("ts", "started").withColumn("ended", F.col("started")), "model-a"
    )
    lake = f"{work_dir(spark, 'chat')}/usage"
    usage_ingest(records.select(F.to_json(F.struct(*[f.name for f in USAGE])).alias("value")), lake)
    return plain(U.usage_report(read_usage_lake(spark, lake)))


_ASKED_SQL = f"""pub AS (
  SELECT event_id, ts, event_type, props,
         CASE WHEN user_id % 7 <> 0 THEN cast(user_id AS varchar) ELSE 'anonymous' END AS user_id
  FROM events WHERE event_type NOT IN ('view', 'signup')),
routed AS (
  SELECT event_id, ts, user_id, cast(0 AS bigint) AS event_no,
         concat(CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'i' ELSE 'r' END, event_id) AS request_id,
         props AS prompt, concat('i', event_id, '#0') AS prompt_id FROM pub
  UNION ALL
  SELECT event_id, ts, user_id, 1, concat('i', event_id), '', concat('i', event_id, '#1') FROM pub
  WHERE event_type = 'purchase')"""
_FED_SQL = admission_sql(
    f"""{_ASKED_SQL}, usage AS (
  SELECT user_id, request_id, prompt_id, ts, prompt,
         CASE WHEN prompt = '' THEN 0 ELSE cast(json_extract_string(prompt, '$.k') AS bigint) END AS tokens_in,
         event_id % 50 AS tokens_out
  FROM routed)"""
).replace("r.request_id, r.ts,", "r.request_id, r.prompt_id, r.ts, r.prompt,").replace("ORDER BY ts, request_id", "ORDER BY ts, prompt_id")
_COST = "round(tokens_in / 1000 * 0.0008 + tokens_out / 1000 * 0.004, 6)"

_MADE_ID = """sha256(concat('{"event_id":', event_id, '}'))"""
_BODY_SQL = """bodies AS (
  SELECT *, event_id % 89 = 0 AS empty FROM events WHERE event_id % 97 <> 0)"""

QUERIES = {
    "metered_chat": (
        metered_chat,
        f"""WITH {_FED_SQL}
SELECT user_id, cast(sum(tokens_in + tokens_out) AS bigint) AS tokens,
       cast(sum(cast({_COST} AS decimal(18,6))) AS double) AS cost_usd, count(*) AS requests
FROM decided WHERE accepted GROUP BY user_id""",
    ),
    "usage_report": (
        usage_report,
        f"""WITH {RECORDS_SQL}
SELECT user_id, cast(sum(total_tokens) AS bigint) AS tokens,
       cast(sum(cast(cost_usd AS decimal(18,6))) AS double) AS cost_usd, count(*) AS requests
FROM records GROUP BY user_id ORDER BY cost_usd DESC, user_id""",
    ),
    "usage_records": (usage_records, f"WITH {RECORDS_SQL} SELECT * FROM records"),
    "usage_counters": (
        usage_counters,
        f"""WITH {admission_sql(USAGE_MONTHS_SQL)}
SELECT user_id, period, cast(sum(tokens_in + tokens_out) AS bigint) AS total_tokens,
       cast(sum(tokens_in) AS bigint) AS tokens_in, cast(sum(tokens_out) AS bigint) AS tokens_out,
       count(*) AS requests, min(ts) + INTERVAL 90 DAY AS expires_at
FROM decided WHERE accepted GROUP BY user_id, period""",
    ),
    "budget_admission": (budget_admission, f"WITH {admission_sql(USAGE_MONTHS_SQL)} SELECT * FROM decided"),
    "budget_admission_sliced": (
        budget_admission_sliced,
        f"WITH {admission_sql(USAGE_MONTHS_SQL)} SELECT * FROM decided",
    ),
    "current_usage": (
        current_usage,
        f"""WITH {RECORDS_SQL}, counters AS (
  SELECT user_id, period, sum(total_tokens) AS used FROM records WHERE tokens_in >= 10 GROUP BY user_id, period)
SELECT u.user_id, strftime(u.ts, '%Y-%m') AS period, u.request_id, u.ts, u.tokens_in, u.tokens_out,
       cast(coalesce(c.used, 0) AS bigint) AS used
FROM usage u LEFT JOIN counters c ON c.user_id = u.user_id AND c.period = strftime(u.ts, '%Y-%m')""",
    ),
    "ttl_filter": (
        ttl_filter,
        f"""WITH {USAGE_MONTHS_SQL}
SELECT user_id, strftime(ts, '%Y-%m') AS period, request_id, ts, tokens_in, tokens_out FROM usage
QUALIFY min(ts) OVER (PARTITION BY user_id, strftime(ts, '%Y-%m')) + INTERVAL 90 DAY > TIMESTAMP '{AS_OF}'""",
    ),
    "ttl_filter_rows": (
        ttl_filter_rows,
        f"""WITH {USAGE_SQL}
SELECT * FROM usage WHERE ts + INTERVAL 7 DAY > TIMESTAMP '2024-01-25 12:00:00'""",
    ),
    "route_prompts": (
        route_prompts,
        f"""WITH {_ASKED_SQL}
SELECT event_id, ts, user_id, event_no, request_id, prompt_id, prompt, concat('/chat/', user_id, '/stream') AS out_channel
FROM routed""",
    ),
    "route_passthrough": (
        route_passthrough,
        """SELECT event_id, concat('/chat/', user_id, '/stream') AS path,
       CASE WHEN user_id % 7 <> 0 THEN cast(user_id AS varchar) END AS sub, cast(1 AS bigint) AS events
FROM events WHERE event_type = 'view'""",
    ),
    "normalize_chat": (
        normalize_chat,
        f"""WITH {_BODY_SQL}
SELECT event_id, CASE WHEN NOT empty AND event_id % 4 <> 0 THEN event_type ELSE '' END AS prompt,
       CASE WHEN empty OR event_id % 5 = 0 THEN 'anonymous' WHEN event_id % 10 = 1 THEN ''
            ELSE cast(user_id AS varchar) END AS actor_id,
       CASE WHEN NOT empty AND event_id % 3 <> 0 AND event_id % 6 <> 1 THEN concat('s', user_id) ELSE {_MADE_ID} END AS session_id
FROM bodies""",
    ),
    "normalize_orders": (
        normalize_orders,
        f"""WITH {_BODY_SQL}
SELECT event_id, {_MADE_ID} AS order_id,
       CASE WHEN NOT empty AND event_id % 7 <> 0 THEN event_type ELSE '(unspecified)' END AS item,
       CASE WHEN NOT empty AND event_id % 8 <> 0 THEN value ELSE 0 END AS amount,
       CASE WHEN NOT empty AND event_id % 9 <> 0 THEN concat(user_id, '@x') ELSE '' END AS customer_email
FROM bodies""",
    ),
    "normalize_rejects": (
        normalize_rejects,
        "SELECT event_id, 'not json' AS body FROM events WHERE event_id % 97 = 0",
    ),
    "out_events": (
        out_events,
        f"""WITH {_FED_SQL}, feed AS (
SELECT request_id, prompt_id, user_id, ts, unnest(range(len(string_split(prompt, ' ')))) AS seq,
       unnest(string_split(prompt, ' ')) AS text, 'token' AS type, 0 AS step, NULL AS code, NULL AS message,
       NULL AS tokens_in, NULL AS tokens_out, NULL AS cost_usd, NULL AS remaining
FROM decided WHERE accepted AND prompt <> ''
UNION ALL
SELECT request_id, prompt_id, user_id, ts, NULL, NULL, 'error', 1, code, message, NULL, NULL, NULL, NULL
FROM decided WHERE NOT accepted
UNION ALL
SELECT request_id, prompt_id, user_id, ts, NULL, NULL, 'done', 1, NULL, NULL, tokens_in, tokens_out, {_COST}, remaining
FROM decided WHERE accepted)
SELECT * EXCLUDE (user_id, seq, step), cast(seq AS bigint) AS seq, cast(step AS bigint) AS step,
       concat('/chat/', user_id, '/stream') AS channel FROM feed""",
    ),
}
