"""Streams in several micro-batches, and batches that run twice."""

import datetime
import glob
import os
import random

import pytest
from tallyline.operators import lifecycle as L
from tallyline.operators import usage as U
from tallyline.schemas import MODEL_EVENT
from tallyline.sources import usage_lake as UL
from tallyline.sources.key_table import KeyTable
from tallyline.streaming import answers as SA
from tallyline.streaming import approvals as SP
from tallyline.streaming import sessions as SS
from tallyline.streaming import usage as SU

START = datetime.datetime(2025, 5, 31, 12, 0, 0)
REQUESTS = "user_id STRING, request_id STRING, ts TIMESTAMP, tokens_in INT, tokens_out INT"
NOW = {"availableNow": True}


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


class Source:
    """A folder that is streamed one file per micro-batch, in the order of writing."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.files = spark, path, schema, 0

    def add(self, rows):
        target = f"{self.path}/{self.files:03d}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(target)
        for file in glob.glob(f"{target}/*.parquet"):
            os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self

    def stream(self, each=1):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", each).parquet(f"{self.path}/*")


def usage_rows(n=240, seed=3):
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "a", "b"]), f"r{i:04d}", at(300 * i), rng.randrange(20), rng.randrange(20))
        for i in range(n)
    ]


def forget_last_commit(checkpoint):
    """Make the query run its last batch again, as after a driver lost before the commit."""
    commits = sorted((int(os.path.basename(p)) for p in glob.glob(f"{checkpoint}/commits/[0-9]*")))
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")


@pytest.fixture
def requests(spark, folder):
    rows = usage_rows()
    source = Source(spark, f"{folder}/in", REQUESTS)
    for part in range(0, len(rows), 80):
        source.add(rows[part : part + 80])
    return source, spark.createDataFrame(rows, REQUESTS)


def test_counters(spark, folder, requests):
    source, rows = requests
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SU.stream_usage_counters(source.stream(), f"{folder}/counters", f"{folder}/cp").awaitTermination()
        want = U.usage_counters(rows)
        got = SU.read_counters(spark, f"{folder}/counters").select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_counters_purge(spark, folder):
    source = Source(spark, f"{folder}/in", REQUESTS)
    source.add([("u", "1", at(0), 1, 1)]).add([("u", "2", at(100 * 86400), 1, 1)])
    SU.stream_usage_counters(source.stream(), f"{folder}/counters", f"{folder}/cp", purge=True).awaitTermination()
    assert [r["period"] for r in SU.read_counters(spark, f"{folder}/counters").collect()] == ["2025-09"]


@pytest.mark.parametrize("parts", [6, None])
def test_admission_in_batches_equals_the_whole(spark, folder, requests, parts):
    source, rows = requests
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SU.stream_budget_admission(
            source.stream(), 600, f"{folder}/out", f"{folder}/counters", f"{folder}/cp", parts=parts
        ).awaitTermination()
        want = U.budget_admission(rows, 600)
        got = spark.read.parquet(f"{folder}/out").select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        counters = U.usage_counters(want.filter("accepted"))
        kept = SU.read_counters(spark, f"{folder}/counters").select(*counters.columns)
        assert kept.exceptAll(counters).count() == counters.exceptAll(kept).count() == 0


def test_lake(spark, folder):
    lines = Source(spark, f"{folder}/in", "value STRING")
    good = '{"user_id":"u","request_id":"%d","tokens_in":3,"ts":"2025-06-0%dT10:00:00+00:00"}'
    lines.add([(good % (1, 1),), ("broken",), (good % (2, 2),)])
    lines.add([(good % (3, 2),), ('{"tokens_in": "x"}',), ('{"other": 1}',), ('{"ts": "soon"}',)])
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SU.stream_usage_lake(lines.stream(), f"{folder}/lake", f"{folder}/cp", trigger=NOW).awaitTermination()
        rows = UL.read_usage_lake(spark, f"{folder}/lake")
        arrived = rows.filter("request_id IS NULL").first()["dt"]
        assert arrived >= datetime.date(2025, 7, 1)  # a record without a time goes by its arrival
        assert sorted((r["request_id"] or "", r["tokens_in"], str(r["dt"])) for r in rows.collect()) == [
            ("", None, str(arrived)),
            ("1", 3, "2025-06-01"),
            ("2", 3, "2025-06-02"),
            ("3", 3, "2025-06-02"),
        ]
        assert UL.read_usage_lake(spark, f"{folder}/lake", "2025-06-02", "2025-06-02").count() == 2
        errors = UL.read_usage_errors(spark, f"{folder}/lake")
        assert {r["value"] for r in errors.collect()} == {"broken", '{"tokens_in": "x"}', '{"ts": "soon"}'} and errors.count() == 3


LINE = '{"user_id":"u","request_id":"%s","tokens_in":1,"ts":"2025-06-0%d 10:00:00"}'


def requests_in(spark, lake, *days):
    return sorted(r["request_id"] for r in UL.read_usage_lake(spark, lake, *days).collect())


def test_files_are_ingested_once(spark, folder):
    paths = []
    for k in range(3):
        paths.append(f"file:{folder}/in{k}.txt")
        with open(f"{folder}/in{k}.txt", "w") as out:
            out.write("\n".join(LINE % (f"{k}{d}", d) for d in (1, 2)))
    lake = f"{folder}/lake"
    assert UL.usage_ingest_files(spark, paths[:2], lake) == paths[:2]
    assert UL.usage_ingest_files(spark, paths[:2], lake) == []
    assert UL.usage_ingest_files(spark, paths, lake) == paths[2:]
    assert requests_in(spark, lake) == ["01", "02", "11", "12", "21", "22"]
    lines = spark.read.text(paths[0])
    for _ in range(2):
        UL.usage_ingest(lines, lake, batch="again")
    assert len(requests_in(spark, lake)) == 8
    # a job that ended before its commit leaves nothing that counts
    UL.write_commit(UL.parse_usage(lines), lake, "i-lost")
    assert len(requests_in(spark, lake)) == 8


def test_compaction_shows_every_record_once(spark, folder, monkeypatch):
    lines = Source(spark, f"{folder}/in", "value STRING")
    for k in range(7):
        lines.add([(LINE % (f"{k}{d}", d),) for d in range(1, 1 + k % 3 + 1)] + [(f"broken {k}",)])
    lake = f"{folder}/lake"
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SU.stream_usage_lake(lines.stream(), lake, f"{folder}/cp", trigger=NOW, compact_every=3).awaitTermination()
        want = sorted(f"{k}{d}" for k in range(7) for d in range(1, 1 + k % 3 + 1))
        assert requests_in(spark, lake) == want
        assert len(UL.live_commits(lake, "usage", "2025-06-01", set())) <= 4
        assert UL.read_usage_errors(spark, lake).count() == 7
    before = UL.read_usage_lake(spark, lake)
    switched, write = [], UL.write_json
    monkeypatch.setattr(UL, "write_json", lambda p, c: (switched.append(requests_in(spark, lake)), write(p, c)))
    assert UL.compact_usage_lake(spark, lake, commits=1) and all(x == want for x in switched)
    assert sorted(r["request_id"] for r in before.collect()) == want  # a reader that had begun
    monkeypatch.undo()
    UL.forget_replaced(lake)
    assert requests_in(spark, lake) == want and UL.compact_usage_lake(spark, lake, commits=1) == []
    assert len(glob.glob(f"{lake}/area=usage/dt=2025-06-01/*")) == 1


def test_only_the_asked_days_are_looked_into(spark, folder, monkeypatch):
    lake = f"{folder}/lake"
    UL.usage_ingest(spark.createDataFrame([(LINE % (d, d),) for d in range(1, 8)], "value STRING"), lake)
    looked, names = [], UL.names_in
    monkeypatch.setattr(UL, "names_in", lambda p: (looked.append(p), names(p))[1])
    rows = UL.read_usage_lake(spark, lake, "2025-06-03", "2025-06-04")
    assert [p[-10:] for p in looked if "/dt=" in p] == ["2025-06-03", "2025-06-04"]
    assert {p.split("/dt=")[1][:10] for p in rows.inputFiles()} == {"2025-06-03", "2025-06-04"} and rows.count() == 2


def test_late_decisions_count_by_the_log(spark, folder):
    orders = Source(spark, f"{folder}/orders", "order_id BIGINT, submitted TIMESTAMP")
    orders.add([(1, at(0))]).add([(4, at(30 * 86400))])
    calls = Source(spark, f"{folder}/calls", "cb BIGINT, ts TIMESTAMP, line INT, decision STRING")
    calls.add([(9, at(40 * 86400), 0, "approve")])
    SP.stream_order_decisions(orders.stream(), calls.stream(), f"{folder}/t", f"{folder}/cp").awaitTermination()
    calls.add([(1, at(10), 0, "approve")])
    SP.stream_order_decisions(orders.stream(), calls.stream(), f"{folder}/t", f"{folder}/cp").awaitTermination()
    every = spark.read.schema(orders.schema).parquet(f"{folder}/orders/*")
    log = spark.read.schema(calls.schema).parquet(f"{folder}/calls/*")
    status = {r["order_id"]: r["status"] for r in SP.read_order_status(spark, f"{folder}/t", every, log).collect()}
    assert status == {1: "APPROVED", 4: "PENDING_APPROVAL"}


def test_lake_by_arrival(spark, folder):
    lines = spark.createDataFrame([('{"user_id":"u","ts":"2001-01-01 00:00:00"}',)], "value STRING")
    UL.usage_ingest(lines, f"{folder}/lake", dt_from="arrival")
    row = UL.read_usage_lake(spark, f"{folder}/lake").first()
    assert row["dt"].year >= 2025 and row["ts"] == datetime.datetime(2001, 1, 1)


@pytest.mark.parametrize("late_first, salts", [(False, 1), (True, 1), (True, 3)])
def test_earliest_decision_wins_in_any_arrival(spark, folder, late_first, salts):
    orders = Source(spark, f"{folder}/orders", "order_id BIGINT, submitted TIMESTAMP")
    orders.add([(1, at(0)), (2, at(0)), (3, at(0))]).add([(4, at(30 * 86400))])
    calls = Source(spark, f"{folder}/calls", "cb BIGINT, ts TIMESTAMP, line INT, decision STRING")
    early, late = [(1, at(10), 0, "approve")], [(1, at(20), 0, "reject"), (2, at(3 * 86400), 0, "approve")]
    for part in ((late, early) if late_first else (early, late)):
        calls.add(part)
    calls.add([(9, at(40 * 86400), 0, "approve")])
    SP.stream_order_decisions(
        orders.stream(), calls.stream(), f"{folder}/t", f"{folder}/cp", salts=salts
    ).awaitTermination()
    all_orders = spark.read.schema(orders.schema).parquet(f"{folder}/orders/*")
    status = {r["order_id"]: (r["status"], r["timed_out"]) for r in SP.read_order_status(spark, f"{folder}/t", all_orders).collect()}
    assert status == {
        1: ("APPROVED", False),
        2: ("PENDING_APPROVAL", True),
        3: ("PENDING_APPROVAL", True),
        4: ("PENDING_APPROVAL", False),
    }


def test_settled_orders_are_no_state(spark, folder):
    """What waits is kept beside the table: nothing in a state store, and settled rows go."""
    orders = Source(spark, f"{folder}/orders", "order_id BIGINT, submitted TIMESTAMP")
    calls = Source(spark, f"{folder}/calls", "cb BIGINT, ts TIMESTAMP, line INT, decision STRING")
    orders.add([(1, at(0)), (2, at(0)), (None, at(0)), (8, None)]).add([(3, at(86400)), (4, at(30 * 86400))])
    calls.add([(1, at(10 + k), k, "approve") for k in range(9)] + [(3, at(86400 + 5), 0, "reject"), (7, None, 0, "approve")])
    calls.add([(1, at(5), 0, "reject"), (9, at(40 * 86400), 0, "approve")])
    SP.stream_order_decisions(
        orders.stream(), calls.stream(), f"{folder}/t", f"{folder}/cp", salts=3, hot_rows=4
    ).awaitTermination()
    every = spark.read.schema(orders.schema).parquet(f"{folder}/orders/*").filter("order_id < 8")
    status = {r["order_id"]: (r["status"], r["timed_out"]) for r in SP.read_order_status(spark, f"{folder}/t", every).collect()}
    assert status == {1: ("REJECTED", False), 2: ("PENDING_APPROVAL", True), 3: ("REJECTED", False), 4: ("PENDING_APPROVAL", False)}
    assert not glob.glob(f"{folder}/cp/state/*/*/*")
    left = [spark.read.parquet(f"{folder}/t-{x}/slot=1") for x in ("orders", "calls")]
    assert [r["order_id"] for r in left[0].collect()] == [4] and [r["cb"] for r in left[1].collect()] == [9]


def test_sessions_close_after_the_gap(spark, folder):
    source = Source(spark, f"{folder}/in", "session_id BIGINT, request_id BIGINT, ts TIMESTAMP")
    source.add([(1, 1, at(0)), (1, 2, at(300)), (2, 3, at(10))]).add([(1, 4, at(901)), (9, 5, at(90000))])
    SS.stream_sessions(source.stream(), "5 minutes", "1 hour", f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").select("session_id", "start", "end", "requests").collect())
    assert got == [(1, at(0), at(600), 2), (1, at(901), at(1201), 1), (2, at(10), at(310), 1)]


def test_registry_takes_failures_as_they_happen(spark, folder):
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2, None]), at(30 * i), rng.choice([0, 1, 1]), 1000 - i if i % 7 else 2**60 + i) for i in range(300)]
    source = Source(spark, f"{folder}/in", "session_id BIGINT, ts TIMESTAMP, held INT, resource BIGINT")
    for part in range(0, len(rows), 100):
        batch = rows[part : part + 100]
        source.add(rng.sample(batch, len(batch)))
    got, stream = (source.stream() for _ in range(2))
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SS.stream_session_registry(
            got.filter("held = 1").drop("held"), stream.filter("held = 0").select("session_id", "ts"), f"{folder}/t", f"{folder}/cp", partitions=2
        ).awaitTermination()
        every = spark.createDataFrame(rows, source.schema)
        want = L.session_registry(every.filter("held = 1"), every.filter("held = 0"), parts=7)
        rows_of = lambda df: sorted(str(tuple(r)) for r in df.select("session_id", "epoch", "since", "resource").collect())
        assert rows_of(SS.read_registry(spark, f"{folder}/t")) == rows_of(want)


def test_untouched_buckets_keep_their_files(spark, folder):
    table = KeyTable(spark, f"{folder}/t", ["k"], "k BIGINT, n BIGINT", buckets=8)
    files = lambda: {p for p in glob.glob(f"{folder}/t/data/*/*/*.parquet")}
    log = "k BIGINT, n BIGINT, no INT"
    table.merge(0, spark.createDataFrame([(k, k, 0) for k in range(40)], log), ["no"], add=["n"])
    first = files()
    change = spark.createDataFrame([(3, 100, 1), (3, 5, 2)], log)
    for _ in range(2):  # a repeated version changes nothing
        table.merge(1, change, ["no"], add=["n"])
        second = files()
        assert len(second - first) == 1 and len(first) == 8 and first < second
        assert {r["k"]: r["n"] for r in table.read().collect()} == {k: k + 105 * (k == 3) for k in range(40)}
    assert {r["n"] for r in table.read(0).filter("k = 3").collect()} == {3}
    table.merge(2, spark.createDataFrame([(50, 1, 0)], log), ["no"], add=["n"])
    assert len(files()) <= 10 and table.versions() == [1, 2]
    assert table.read().count() == 41 and table.read(1).count() == 40
    gone = spark.createDataFrame([(k, None, 0, True) for k in range(51)], "k BIGINT, n BIGINT, no INT, gone BOOLEAN")
    table.merge(3, gone, ["no"], add=["n"], delete_flag="gone")
    assert table.read().count() == 0 and table.read(2).count() == 41


def test_a_batch_reads_only_its_buckets(spark, folder):
    table = SU.counter_table(spark, f"{folder}/c", 16)
    rows = spark.createDataFrame(usage_rows(), REQUESTS)
    table.apply(0, U.usage_counters(rows), SU._charge)
    touched = table.touched(spark.createDataFrame([("a", "2025-05")], "user_id STRING, period STRING"))
    assert len(touched) == 1 and 0 < len(table.read(0, touched).inputFiles()) < len(table.read(0).inputFiles())


def test_text_assembly(spark, folder):
    def text(request, seq, value, sec):
        return (request, seq, at(sec), ((value,),), None)

    source = Source(spark, f"{folder}/in", f"request_id STRING, seq BIGINT, ts TIMESTAMP, {MODEL_EVENT}")
    source.add([text("a", i, f"a{i} ", i) for i in range(4)] + [text("b", 0, "b", 0), text("c", 0, "lost", 0)])
    source.add([text("a", i, f"a{i} ", i) for i in range(4, 7)] + [("a", 7, at(8), None, ((5, 6),))])
    source.add([("b", 1, at(9), None, ((1, None),)), text("d", 0, "open", 9000)])
    for again in (False, True):
        if again:
            forget_last_commit(f"{folder}/cp")
        SA.stream_text_assembly(
            source.stream(), f"{folder}/answers", f"{folder}/batches", f"{folder}/pending", f"{folder}/cp"
        ).awaitTermination()
        rows = spark.read.parquet(f"{folder}/answers").collect()
        got = sorted((r["request_id"], r["complete"], r["answer"], r["tokens_in"], r["tokens_out"]) for r in rows)
        assert got == [
            ("a", True, "".join(f"a{i} " for i in range(7)), 5, 6),
            ("b", True, "b", 1, 0),
            ("c", False, "lost", 0, 0),
        ]
        batches = spark.read.parquet(f"{folder}/batches").filter("request_id = 'a'").orderBy("batch").collect()
        assert [len(r["texts"]) for r in batches] == [5, 2]
