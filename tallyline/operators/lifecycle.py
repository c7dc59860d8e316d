"""Session lifecycles: idle policy, resource registry, rollup of spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.prefix import carry, cut, slice_window, sliced
from tallyline.functions.skew import same_key_join

# Suspend after 5 minutes idle, end after 30 more minutes.
IDLE_SECONDS = 300
SUSPENDED_SECONDS = 1800
# What a span says where its caller does not, and the names of its attributes.
SPAN_DEFAULTS = {"session_id": "no-session", "request_id": "no-request", "actor_id": "anonymous"}
SPAN_KEYS = {"session_id": "session.id", "request_id": "request.id", "actor_id": "actor.id"}
AGENT_ATTRIBUTES = {"agent.name": "support-agent", "agent.version": "1.0.0"}


def idle_lifecycle(
    requests: DataFrame,
    idle_seconds: int = IDLE_SECONDS,
    suspended_seconds: int = SUSPENDED_SECONDS,
    parts: int | None = None,
) -> DataFrame:
    """How the session's instance serves each request (session_id, request_id, ts).

    `warm` within the idle time of the request before, `resumed` within the suspended time
    after that, else `new`: the old instance has ended. `instance` counts from 1. Requests
    without a session are one session. `parts` sets the number of ranges (`functions.prefix`).
    """
    cuts = cut(requests, ["session_id"], ["ts", "request_id"], parts=parts, _last=(F.max("ts"), F.max))
    window = slice_window(cuts)
    gap = F.unix_micros("ts") - F.unix_micros(F.coalesce(F.lag("ts").over(window), F.col("_last")))
    idle, gone = idle_seconds * 1_000_000, (idle_seconds + suspended_seconds) * 1_000_000
    state = F.when(F.col("_gap") <= idle, "warm").when(F.col("_gap") <= gone, "resumed").otherwise("new")
    staged = (
        sliced(requests, cuts)
        .withColumn("_gap", gap)
        .withColumn("state", state)
        .withColumn("_start", (F.col("state") == "new").cast("int"))
    )
    running = F.sum("_start").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        carry(staged, cuts, _starts=(F.sum("_start"), F.sum))
        .withColumn("instance", F.coalesce("_starts", F.lit(0)) + running)
        .withColumn("gap_seconds", F.col("_gap") / 1_000_000)
        .select(*requests.columns, "gap_seconds", "state", "instance")
    )


def assignment_epochs(assignments: DataFrame, failures: DataFrame, parts: int | None = None) -> DataFrame:
    """Assignments (session_id, ts, resource) with `epoch`, the number of failures
    (session_id, ts) of the session until then. A failure comes before an assignment of the
    same time. Events without a session belong to one session."""
    resource = assignments.schema["resource"].dataType
    none = F.lit(None).cast(resource).alias("resource")
    events = assignments.select("session_id", "ts", "resource", F.lit(1).alias("_held")).unionByName(
        failures.select("session_id", "ts", none, F.lit(0).alias("_held"))
    )
    failed = F.sum(1 - F.col("_held"))
    cuts = cut(events, ["session_id"], ["ts", "_held"], parts=parts, _failed=(failed, F.sum))
    until_now = slice_window(cuts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sliced(events, cuts)
        .withColumn("epoch", F.coalesce("_failed", F.lit(0)) + failed.over(until_now))
        .filter("_held = 1")
        .select("session_id", "epoch", "ts", "resource")
    )


def first_of_epoch(offers: DataFrame) -> DataFrame:
    """The first offer (session_id, epoch, ts, resource) of each session and epoch."""
    first = F.min(F.struct("ts", "resource")).alias("_first")
    return (
        offers.groupBy("session_id", "epoch")
        .agg(first)
        .select(
            "session_id", "epoch", F.col("_first.ts").alias("since"), F.col("_first.resource").alias("resource")
        )
    )


def session_registry(assignments: DataFrame, failures: DataFrame, **slicing) -> DataFrame:
    """The resource each session holds, per epoch: the first assignment wins until a failure
    drops it and the next one replaces it."""
    return first_of_epoch(assignment_epochs(assignments, failures, **slicing))


def with_span_defaults(spans: DataFrame) -> DataFrame:
    """Spans with the defaults of missing ids, and their `attributes` as every span carries them.

    A span's own attributes (a map, if the table has them) stay; the five fixed ones are set over.
    """
    ids = {name: F.coalesce(F.col(name).cast("string"), F.lit(text)) for name, text in SPAN_DEFAULTS.items()}
    fixed = F.create_map(
        *[x for name, key in SPAN_KEYS.items() for x in (F.lit(key), ids[name])],
        *[F.lit(x) for pair in AGENT_ATTRIBUTES.items() for x in pair],
    )
    own = F.coalesce("attributes", F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))
    if "attributes" in spans.columns:
        fixed = F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(fixed, k)), fixed)
    return spans.withColumns({**ids, "attributes": fixed})


def session_rollup(spans: DataFrame) -> DataFrame:
    """Spans or turns (session_id, request_id, actor_id, ts) grouped into conversations.

    If spans have `attributes` (a map of texts), a conversation has them merged: of each
    attribute the value of the last span that has one, by `ts`, then `request_id`, then the value.
    """
    sessions = spans.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("turns"),
        F.countDistinct("request_id").alias("requests"),
        F.min("actor_id").alias("actor_id"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    if "attributes" not in spans.columns:
        return sessions
    last = F.max(F.struct("ts", "request_id", "value"))["value"].alias("value")
    merged = (
        spans.select("session_id", "ts", "request_id", F.explode("attributes").alias("key", "value"))
        .filter("value IS NOT NULL")
        .groupBy("session_id", "key")
        .agg(last)
        .groupBy("session_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("attributes"))
    )
    return same_key_join(sessions, merged, ["session_id"], "left")
