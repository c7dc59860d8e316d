"""Metering against a row-by-row simulation, with and without sliced tenants."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import answers as A
from tallyline.operators import usage as U

START = datetime.datetime(2025, 5, 30, 23, 0, 0)
SCHEMA = "user_id STRING, request_id STRING, ts TIMESTAMP, tokens_in INT, tokens_out INT"


def simulate(rows, limit, opening=None):
    used = dict(opening or {})
    out = {}
    for user, request, ts, t_in, t_out in sorted(rows, key=lambda r: (r[2], r[1])):
        key = (user, ts.strftime("%Y-%m"))
        have = used.get(key, 0)
        if have >= limit:
            out[request] = (False, have, None)
        else:
            tokens = (t_in or 0) + (t_out or 0)
            out[request] = (True, have, max(0, limit - have - tokens))
            used[key] = have + tokens
    return out


def generate(seed, n=400):
    rng = random.Random(seed)
    return [
        (
            None if rng.random() < 0.6 else f"u{rng.randrange(6)}",
            f"r{i:04d}",
            START + datetime.timedelta(seconds=rng.randrange(0, 7200)),
            rng.choice([None, 0, 1, rng.randrange(30)]),
            rng.choice([0, rng.randrange(60)]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [1, 500, 2500])
@pytest.mark.parametrize("parts", [9, None])
def test_admission_equals_simulation(spark, seed, limit, parts):
    rows = generate(seed)
    decided = U.budget_admission(spark.createDataFrame(rows, SCHEMA), limit, parts=parts)
    got = {r["request_id"]: (r["accepted"], r["used"], r["remaining"]) for r in decided.collect()}
    assert got == simulate(rows, limit)


@pytest.mark.parametrize("parts", [9, None])
def test_admission_with_opening_balances(spark, parts):
    rows = generate(9)
    opening = {(None, "2025-05"): 700, ("u1", "2025-05"): 5000, ("u2", "2025-06"): 40, ("gone", "2025-05"): 3}
    used = spark.createDataFrame([(*k, v) for k, v in opening.items()], "user_id STRING, period STRING, used BIGINT")
    for limit in (600, 1500):
        decided = U.budget_admission(
            spark.createDataFrame(rows, SCHEMA), limit, used, parts=parts
        )
        got = {r["request_id"]: (r["accepted"], r["used"], r["remaining"]) for r in decided.collect()}
        assert got == simulate(rows, limit, opening)


def test_router(spark):
    schema = "path STRING, sub STRING, invocation_id STRING, events ARRAY<STRUCT<payload: STRUCT<prompt: STRING, request_id: STRING>>>"
    publishes = spark.createDataFrame(
        [
            ("/chat/a/prompt", "a", "i1", [(("hi", "r1"),), (("", None),), (None,)]),
            ("/chat/a/prompt", None, "i2", [((None, "r2"),)]),
            ("/chat/a/prompt", "a", "i3", []),
            ("/chat/a/prompt", "a", "i4", None),
            ("/chat/a/stream", "a", "i5", [(("own output", "r3"),)]),
            (None, "a", "i6", []),
        ],
        schema,
    )
    prompts, others = U.route_prompts(publishes)
    got = {(r["user_id"], r["request_id"], r["prompt"], r["event_no"]) for r in prompts.collect()}
    assert got == {("a", "r1", "hi", 0), ("a", "i1", "", 1), ("a", "i1", "", 2), ("anonymous", "r2", "", 0)}
    assert others.select("path").distinct().count() == 2 and others.count() == 2


def test_request_defaults(spark):
    bodies = [
        (1, '{"prompt": "p", "actor_id": "", "session_id": ""}'),
        (2, None),
        (3, ""),
        (4, '{"prompt": null, "session_id": "s"}'),
        (5, "[1"),
        (6, '{"session_id": "s", "prompt": {"a": 1}}'),
    ]
    raw = spark.createDataFrame(bodies, "no INT, body STRING")
    rows, rejects = U.normalize_requests(raw, "chat", key=["no"])
    got = {r["no"]: (r["prompt"], r["actor_id"], r["session_id"]) for r in rows.collect()}
    assert got[1][:2] == ("p", "") and len(got[1][2]) == 64
    assert got[2][:2] == got[3][:2] == ("", "anonymous") and got[2][2] != got[3][2]
    assert got[4] == ("", "anonymous", "s")
    assert [r["no"] for r in rejects.collect()] == [5]
    again = {r["no"]: r["session_id"] for r in U.normalize_requests(raw, "chat", key=["no"])[0].collect()}
    assert all(got[no][2] == again[no] for no in got)
    live = {r["no"]: r["session_id"] for r in U.normalize_requests(raw, "chat", live=True)[0].collect()}
    assert len(live[2]) == 36


def test_new_order_defaults(spark):
    raw = spark.createDataFrame([(1, '{"item": "", "amount": 12.5}'), (2, "{}")], "no INT, body STRING")
    rows = {r["no"]: r for r in U.normalize_requests(raw, "order", key=["no"])[0].collect()}
    assert (rows[1]["item"], float(rows[1]["amount"]), rows[1]["customer_email"]) == ("", 12.5, "")
    assert (rows[2]["item"], float(rows[2]["amount"]), len(rows[2]["order_id"])) == ("(unspecified)", 0, 64)


def test_equal_bodies_are_two_orders(spark):
    raw = spark.createDataFrame([(n, '{"item": "x", "amount": 10.555}') for n in (1, 2)], "no INT, body STRING")
    rows = U.normalize_requests(raw, "order", key=["no"])[0].collect()
    assert len({r["order_id"] for r in rows}) == 2 and {str(r["amount"]).rstrip("0") for r in rows} == {"10.555"}
    with pytest.raises(ValueError, match="identify"):
        U.normalize_requests(raw, "order")


def test_prompts_of_one_publish_keep_apart(spark):
    event = {
        "info": {"channel": {"path": "/chat/u/prompt"}},
        "identity": {"claims": {"sub": "u"}},
        "events": [{"payload": {"prompt": "p"}}, {"payload": {"prompt": "q"}}, {}],
    }
    raw = spark.createDataFrame([("i1", json.dumps(event)), ("i2", "no json"), ("i3", None)], "invocation_id STRING, event STRING")
    prompts, others = U.route_prompts(U.parse_publishes(raw))
    rows = sorted((r["prompt_id"], r["request_id"], r["user_id"], r["prompt"]) for r in prompts.collect())
    assert rows == [("i1#0", "i1", "u", "p"), ("i1#1", "i1", "u", "q"), ("i1#2", "i1", "u", "")]
    assert others.count() == 2
    at = datetime.datetime(2025, 1, 1)
    asked = prompts.withColumn("ts", F.lit(at)).withColumn("tokens_in", F.lit(60)).withColumn("tokens_out", F.lit(0))
    decided = U.budget_admission(asked, 100, key="prompt_id")
    assert {r["prompt_id"]: r["accepted"] for r in decided.collect()} == {"i1#0": True, "i1#1": True, "i1#2": False}
    deltas = spark.createDataFrame([("i1#0", 0, "a"), ("i1#1", 0, "b"), ("i1#2", 0, "c")], "prompt_id STRING, seq BIGINT, text STRING")
    feed = A.out_events(deltas, decided.withColumn("cost_usd", F.lit(0.1)), key="prompt_id")
    assert sorted((r["prompt_id"], r["text"]) for r in feed.filter("type = 'token'").collect()) == [("i1#0", "a"), ("i1#1", "b")]
    answers = A.reassemble_answer(deltas, key="prompt_id").collect()
    assert {r["prompt_id"]: r["answer"] for r in answers} == {"i1#0": "a", "i1#1": "b", "i1#2": "c"}


@pytest.mark.parametrize("parts", [4, None])
def test_rows_without_a_tenant_can_be_hot(spark, parts):
    at = datetime.datetime(2025, 1, 1)
    rows = [(None if k % 2 else "a", f"{k:02d}", at + datetime.timedelta(minutes=k), 10, 0) for k in range(18)]
    decided = U.budget_admission(spark.createDataFrame(rows, SCHEMA), 45, parts=parts).collect()
    assert sorted((str(r["user_id"]), r["request_id"]) for r in decided if r["accepted"]) == sorted(
        (str(None if k % 2 else "a"), f"{k:02d}") for k in range(10)
    )


def test_expiry_counts_from_the_first_write(spark):
    days = [datetime.datetime(2025, 1, 10), datetime.datetime(2025, 1, 30)]
    rows = spark.createDataFrame([("u", "1", days[0], 1, 1), ("u", "2", days[1], 1, 1), ("v", "3", days[1], 1, 1)], SCHEMA)
    counters = U.usage_counters(rows)
    assert counters.filter("user_id = 'u'").first()["expires_at"] == datetime.datetime(2025, 4, 10)
    as_of = F.lit("2025-04-10 00:00:00").cast("timestamp")
    assert [r["user_id"] for r in U.ttl_filter(counters, as_of, 90).collect()] == ["v"]
    kept = U.ttl_filter(rows.withColumn("period", U.period_of("ts")), as_of, 90, ["user_id", "period"])
    assert [r["request_id"] for r in kept.collect()] == ["3"]
    assert U.ttl_filter(rows, as_of, 90).count() == 2


def test_missing_counter_is_zero(spark):
    rows = spark.createDataFrame(generate(4, 20), SCHEMA)
    none = U.usage_counters(rows.limit(0))
    assert {r["used"] for r in U.current_usage(rows, none).collect()} == {0}
