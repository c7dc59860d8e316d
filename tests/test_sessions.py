"""Session lifecycles, approvals and keyed tables against plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import approvals as AP
from tallyline.operators import keyed as K
from tallyline.operators import lifecycle as L

START = datetime.datetime(2025, 3, 1)
SLICED = [{}, {"parts": 8}]


def seconds(n):
    return START + datetime.timedelta(seconds=n)


@pytest.mark.parametrize("options", SLICED)
def test_idle_lifecycle(spark, options):
    rng = random.Random(8)
    rows, at = [], {"a": 0, None: 0}
    for i in range(200):
        session = rng.choice(["a", None, None, None])
        at[session] += rng.choice([0, 1, 299, 300, 301, 2100, 2101, 9000])
        rows.append((session, i, seconds(at[session])))
    last, number, want = {}, {}, {}
    for session, i, ts in rows:
        gap = (ts - last[session]).total_seconds() if session in last else None
        state = "new" if gap is None or gap > 2100 else "warm" if gap <= 300 else "resumed"
        number[session] = number.get(session, 0) + (state == "new")
        last[session] = ts
        want[i] = (state, number[session], gap)
    table = spark.createDataFrame(rows, "session_id STRING, request_id INT, ts TIMESTAMP")
    got = {r["request_id"]: (r["state"], r["instance"], r["gap_seconds"]) for r in L.idle_lifecycle(table, **options).collect()}
    assert got == want


@pytest.mark.parametrize("options", SLICED)
def test_registry(spark, options):
    rng = random.Random(2)
    offers, failures, want, held, epoch = [], [], {}, {}, {}
    for i in range(150):
        session = rng.choice(["a", None, None, None])
        if rng.random() < 0.2:
            failures.append((session, seconds(60 * i)))
            epoch[session] = epoch.get(session, 0) + 1
        else:
            offers.append((session, seconds(60 * i), i))
            want.setdefault((session, epoch.get(session, 0)), i)
    registry = L.session_registry(
        spark.createDataFrame(offers, "session_id STRING, ts TIMESTAMP, resource BIGINT"),
        spark.createDataFrame(failures, "session_id STRING, ts TIMESTAMP"),
        **options,
    )
    assert {(r["session_id"], r["epoch"]): r["resource"] for r in registry.collect()} == want


def test_rollup(spark):
    rows = [("s", "r1", None, seconds(5)), ("s", "r1", "ann", seconds(1)), ("s", "r2", "ann", seconds(9)), ("t", "r1", None, seconds(0))]
    spans = spark.createDataFrame(rows, "session_id STRING, request_id STRING, actor_id STRING, ts TIMESTAMP")
    s, t = L.session_rollup(spans).orderBy("session_id").collect()
    assert tuple(s) == ("s", 3, 2, "ann", seconds(1), seconds(9))
    assert tuple(t) == ("t", 1, 1, None, seconds(0), seconds(0))


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_order_decisions(spark, hot_rows):
    day = 86400
    orders = [(1, seconds(0)), (2, seconds(0)), (3, seconds(0)), (4, seconds(0)), (5, seconds(10 * day))]
    calls = (
        [(1, seconds(2 * day), 0, "approve")]
        + [(2, seconds(2 * day + 1), 0, "approve"), (2, seconds(-1), 0, "approve")]
        + [(3, seconds(50 - i), i, "approve" if i == 40 else "no") for i in range(50)]
        + [(3, seconds(1), 0, "approve"), (9, seconds(0), 0, "approve")]
    )
    got = AP.order_decisions(
        spark.createDataFrame(orders, "order_id BIGINT, submitted TIMESTAMP"),
        spark.createDataFrame(calls, "cb BIGINT, ts TIMESTAMP, line INT, decision STRING"),
        F.lit(seconds(3 * day)),
        hot_rows=hot_rows,
        tie="line",
    )
    assert {r["order_id"]: (r["status"], r["timed_out"]) for r in got.collect()} == {
        1: ("APPROVED", False),
        2: ("PENDING_APPROVAL", True),
        3: ("APPROVED", False),
        4: ("PENDING_APPROVAL", True),
        5: ("PENDING_APPROVAL", False),
    }


def test_equal_times_have_one_answer(spark):
    rows = [(1, seconds(5), 2, "reject"), (1, seconds(5), 2, "approve"), (1, seconds(5), 3, "a"), (1, seconds(9), 0, "a")]
    for order in (rows, rows[::-1]):
        calls = spark.createDataFrame(order, "cb INT, ts TIMESTAMP, line INT, decision STRING")
        assert [tuple(r) for r in AP.first_decision(calls, ["cb"], ["ts", "line"]).collect()] == [rows[1]]


def test_put_replaces_the_whole_row(spark):
    schema = "k INT, no INT, a STRING, b STRING"
    base = spark.createDataFrame([(1, 0, "x", "y"), (2, 0, "x", "y")], schema)
    log = spark.createDataFrame([(1, 1, "n", None), (1, 3, None, "z"), (1, 2, "m", "m"), (3, 1, "q", "q")], schema)
    got = {r["k"]: (r["a"], r["b"]) for r in K.keyed_put(base, log, ["k"], ["no"]).collect()}
    assert got == {1: (None, "z"), 2: ("x", "y"), 3: ("q", "q")}


def test_merge_equals_step_by_step(spark):
    rng = random.Random(4)
    base = [(k, f"s{k}", rng.choice([None, 5]), rng.choice([None, 7]), "kept") for k in range(8)]
    log = [
        (rng.randrange(12), no, rng.choice([None, f"t{no}"]), rng.choice([None, 1, 2]), rng.choice([None, no]), rng.random() < 0.1)
        for no in range(200)
    ]
    want = {k: [s, t, f, o] for k, s, t, f, o in base}
    for k, _, s, t, f, gone in log:
        if gone:
            want.pop(k, None)
            continue
        row = want.setdefault(k, [None, None, None, None])
        row[0] = s if s is not None else row[0]
        row[1] = row[1] if t is None else (row[1] or 0) + t
        row[2] = row[2] if row[2] is not None else f
    rng.shuffle(log)
    merged = K.keyed_merge(
        spark.createDataFrame(base, "k INT, status STRING, total INT, first INT, other STRING"),
        spark.createDataFrame(log, "k INT, no INT, status STRING, total INT, first INT, gone BOOLEAN"),
        ["k"],
        ["no"],
        set=["status"],
        add=["total"],
        set_if_absent=["first"],
        delete_flag="gone",
    )
    assert {r["k"]: [r["status"], r["total"], r["first"], r["other"]] for r in merged.collect()} == want
