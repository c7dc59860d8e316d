"""Answers, files and memory against plain Python."""

import base64
import datetime
import glob
import pathlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tallyline.operators import answers as A
from tallyline.operators import files as FI
from tallyline.operators import memory as M
from tallyline.schemas import MODEL_EVENT
from tallyline.sources import folder as folders


def events_of(spark, rows):
    """(request, seq, text or None, usage tuple or None) as model events."""
    nested = [
        (r, s, None if text is None else ((text[0],),), None if usage is None else ((usage,) if usage else (None,)))
        for r, s, text, usage in rows
    ]
    return spark.createDataFrame(nested, f"request_id STRING, seq BIGINT, {MODEL_EVENT}")


def test_deltas_and_usage(spark):
    model = events_of(
        spark,
        [
            ("a", 0, ("He",), None),
            ("a", 1, ("",), None),
            ("a", 2, (None,), None),
            ("a", 3, ("y",), None),
            ("a", 4, None, (1, 1)),
            ("a", 5, None, (7, None)),
            ("b", 0, ("x",), None),
            ("c", 0, None, ()),
        ],
    )
    assert [(r["request_id"], r["seq"], r["text"]) for r in A.text_deltas(model).orderBy("request_id", "seq").collect()] == [
        ("a", 0, "He"),
        ("a", 3, "y"),
        ("b", 0, "x"),
    ]
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "request_id STRING")
    usage = {r["request_id"]: (r["tokens_in"], r["tokens_out"]) for r in A.final_usage(asked, model).collect()}
    assert usage == {"a": (7, 0), "b": (0, 0), "c": (0, 0), "d": (0, 0)}


@pytest.mark.parametrize("options", [{}, {"parts": 12}])
def test_batches_put_the_answer_back_together(spark, options):
    rng = random.Random(5)
    words = {r: [f"{r}{i} " for i in range(n)] for r, n in (("a", 143), ("b", 5), ("c", 1), ("d", 11))}
    rows = [(r, 3 * i, w) for r, ws in words.items() for i, w in enumerate(ws)]
    rng.shuffle(rows)
    deltas = spark.createDataFrame(rows, "request_id STRING, seq BIGINT, text STRING")
    batches = {(r["request_id"], r["batch"]): r["texts"] for r in A.chunk_batches(deltas, 5, **options).collect()}
    for request, ws in words.items():
        mine = [batches.pop((request, no)) for no in range(-(-len(ws) // 5))]
        assert mine == [ws[i : i + 5] for i in range(0, len(ws), 5)]
    assert not batches
    whole = {r["request_id"]: r["answer"] for r in A.reassemble_answer(deltas, 16).collect()}
    assert whole == {r: "".join(ws) for r, ws in words.items()}


def test_clean_answers(spark):
    raw = [
        (b"plain \xe2\x82\xac", False, "plain €"),
        (b"cut \xe2\x82", False, "cut �"),
        (b"data: He\ndata:llo \nevent: x\n data: no", False, "Hello"),
        ("data:  x﻿\ndata: y\r".encode(), False, "xy"),
        (b"say data: here", False, ""),
        (b" ```python\nprint(1)\n``` \x1c", True, "print(1)"),
        (b"```print(2)", True, "print(2)"),
        ("﻿x\u0085".encode(), True, "﻿x"),
    ]
    table = spark.createDataFrame([(i, bytearray(r), c) for i, (r, c, _) in enumerate(raw)], "i INT, raw BINARY, is_code BOOLEAN")
    got = [r["clean"] for r in A.clean_answers(table).orderBy("i").collect()]
    assert got == [want for _, _, want in raw]


UBER = base64.b64encode("über".encode()).decode()
# method, path, body, encoded, then by hand: name, content, status in this order
LOG = [
    ("GET", "/files", None, False, None, None, 200),
    ("PUT", "//files/a/deeper", "text é", False, "a", "text é", 201),
    ("GET", "/files/a", None, None, "a", None, 200),
    ("PUT", "/files/a", UBER, True, "a", "über", 201),
    ("PUT", "/files/b", "%%", True, "b", "", 201),
    ("PUT", "/files/c", "YQ", True, "c", None, 500),
    ("GET", "/files/c", None, False, "c", None, 404),
    ("PUT", "/files/c", "YQ==YQ==", True, "c", "a", 201),
    ("PUT", "/files/d", "=Y=W\nI=", True, "d", "ab", 201),
    ("PUT", "/files/d", "YWJj*YQ=", True, "d", None, 500),
    ("PUT", "/files/e", base64.b64encode(b"\xff").decode(), True, "e", None, 500),
    ("PUT", "/files/f", None, True, "f", "", 201),
    ("DELETE", "/files/b", None, False, "b", None, 200),
    ("DELETE", "/files/b", None, False, "b", None, 404),
    ("PUT", "/files/..", "x", False, "..", None, 500),
    ("GET", "/files/..", None, False, "..", None, 404),
    ("PUT", "/files/.", "x", False, ".", None, 500),
    ("PUT", "/files/.env", "K=1", False, ".env", "K=1", 201),
    ("GET", "/files/.env", None, False, ".env", None, 200),
    ("PUT", "/files/", "x", False, None, "x", 400),
    ("POST", "/files/a", "x", False, "a", None, 400),
    (None, "/files/a", "x", False, "a", None, 400),
    ("DELETE", "/files", None, False, None, None, 400),
    ("GET", "/files/a", None, False, "a", None, 200),
]
LEFT = {"a": "über", "c": "a", "d": "ab", "f": "", ".env": "K=1"}


def file_ops(spark, log):
    at = datetime.datetime(2025, 1, 1)
    raw = spark.createDataFrame(
        [(k, at, *row[:4]) for k, row in enumerate(log)],
        "seq BIGINT, ts TIMESTAMP, method STRING, path STRING, body STRING, is_base64 BOOLEAN",
    )
    return FI.file_ops_normalize(raw)


@pytest.mark.parametrize("options", [{}, {"parts": 9}])
def test_file_log_by_hand(spark, options):
    ops = file_ops(spark, LOG)
    got = {r["seq"]: (r["name"], r["content"]) for r in ops.collect()}
    assert got == {k: (row[4], row[5]) for k, row in enumerate(LOG)}
    status = {r["seq"]: r["status"] for r in FI.file_op_status(ops, **options).collect()}
    assert status == {k: row[6] for k, row in enumerate(LOG)}
    assert {r["name"]: r["content"] for r in FI.file_log_compact(ops).collect()} == LEFT


def test_long_encoded_body(spark):
    text = "é" * 200_000
    ops = file_ops(spark, [("PUT", "/files/a", base64.b64encode(text.encode()).decode(), True)])
    assert ops.first()["content"] == text


def test_log_on_an_existing_folder(spark, folder):
    path = f"{folder}/files"
    folders.put_files(spark.createDataFrame([("b", "old"), ("a", "old"), ("z", "stays"), ("..", "no")], "name STRING, content STRING"), path)
    folders.apply_log(file_ops(spark, LOG), path)
    names = folders.list_files(spark, path)
    found = {r["name"]: r["content"] for r in folders.read_files(path, names.select("name")).collect()}
    assert found == LEFT | {"z": "stays"}


def test_paths_as_spark_names_them():
    assert folders.file_system("file:///tmp/x")[1] == "/tmp/x"
    assert folders.file_system("dbfs:/mnt/x")[1] == "/dbfs/mnt/x"


def test_folder_of_files(spark, folder):
    files = spark.createDataFrame([("b.txt", "zwei\n\nü"), ("a.txt", ""), ("c", "old")], "name STRING, content STRING")
    path = f"{folder}/files"
    folders.put_files(files, path)
    folders.put_files(spark.createDataFrame([("c", "new")], files.schema), path)
    below = pathlib.Path(path) / "sub"
    below.mkdir()
    (below / "deeper.txt").write_text("x")
    (below.parent / "raw").write_bytes(b"\xff")
    listed = [(r["name"], r["bytes"]) for r in folders.list_files(spark, path).collect()]
    assert listed == [("a.txt", 0), ("b.txt", 8), ("c", 3), ("raw", 1)]
    asked = spark.createDataFrame([("c",), ("c",), ("a.txt",), ("b.txt",), ("sub",), ("none",), ("raw",), (None,)], "name STRING")
    got = sorted((str(r["name"]), r["content"], r["found"]) for r in folders.read_files(path, asked).collect())
    assert got == sorted(
        [("c", "new", True), ("c", "new", True), ("a.txt", "", True), ("b.txt", "zwei\n\nü", True),
         ("sub", None, False), ("none", None, False), ("raw", None, True), ("None", None, False)],
        key=lambda r: (r[0], r[1] or ""),
    )


def brute_recall(queries, records, k, threshold):
    out = set()
    for q, space, v in queries:
        scored = []
        for s, r, w in records:
            if s == space:
                v64, w64 = np.float32(v).astype(float), np.float32(w).astype(float)
                n = np.linalg.norm(v64) * np.linalg.norm(w64)
                scored.append((-round(float(v64 @ w64) / n, 6) if n else 0.0, r))
        kept = [(s, r) for s, r in sorted(scored) if -s >= threshold][:k]
        out |= {(q, space, r, round(-s, 6) + 0.0, i + 1) for i, (s, r) in enumerate(kept)}
    return out


@pytest.mark.parametrize("block_rows", [7, 10_000])
@pytest.mark.parametrize("threshold", [0.0, 0.5])
def test_recall_equals_brute_force(spark, block_rows, threshold):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 4)).round(2)
    spaces = ["/facts/x"] * 40 + ["/facts/y"] * 5 + ["/facts/z"]
    records = [(s, f"m{i:02d}", [float(x) for x in base[i % 12]]) for i, s in enumerate(spaces)]
    records.append(("/facts/x", "zero", [0.0] * 4))
    queries = [(i, s, [float(x) for x in rng.normal(size=4).round(2)]) for i, s in enumerate(["/facts/x"] * 20 + ["/facts/y", "/facts/none"])]
    found = M.recall_in_namespace(
        spark.createDataFrame(queries, "query_id BIGINT, namespace STRING, embedding ARRAY<FLOAT>"),
        spark.createDataFrame(records, "namespace STRING, record_id STRING, embedding ARRAY<FLOAT>"),
        3,
        threshold,
        block_rows,
    )
    got = {(r["query_id"], r["namespace"], r["record_id"], r["score"] + 0.0, r["rank"]) for r in found.collect()}
    assert got == brute_recall(queries, records, 3, threshold)


@pytest.mark.parametrize("threshold", [-1.0, 0.3, 0.9])
def test_recall_in_a_large_namespace_leaves_blocks_out(spark, threshold):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 6))
    vectors = lambda n: (centres[rng.integers(0, 20, n)] + 0.1 * rng.normal(size=(n, 6))).round(3)
    records = [("/big", f"m{i:03d}", [float(x) for x in v]) for i, v in enumerate(vectors(400))]
    records += [("/big", f"same{i}", records[0][2]) for i in range(30)] + [("/small", "s", [1.0] * 6), ("/big", "zero", [0.0] * 6)]
    queries = [(i, "/big", [float(x) for x in v]) for i, v in enumerate(vectors(30))] + [(40, "/big", [0.0] * 6), (41, "/small", [1.0] * 6)]
    asked = spark.createDataFrame(queries, "query_id BIGINT, namespace STRING, embedding ARRAY<FLOAT>")
    stored = spark.createDataFrame(records, "namespace STRING, record_id STRING, embedding ARRAY<FLOAT>")
    found = M.recall_in_namespace(asked, stored, 3, threshold, 16)
    got = {(r["query_id"], r["namespace"], r["record_id"], r["score"] + 0.0, r["rank"]) for r in found.collect()}
    assert got == brute_recall(queries, records, 3, threshold)
    usable = M._usable(stored)
    index = M.block_index(usable, usable.groupBy("namespace", "_length").count().filter("count > 16").withColumnRenamed("count", "_rows"), 16)
    large = M._usable(asked).filter("namespace = '/big' AND query_id < 40").withColumn("_floor", F.lit(0.9))
    looked = M.block_visits(large, index, home=False).selectExpr("sum(size(_visits)) AS into", "sum(_known) AS known").first()
    assert looked["known"] > 30 * 20 and looked["into"] < looked["known"] / 3


def clustered(rng, n):
    centres = np.random.default_rng(5).normal(size=(20, 6))
    return (centres[rng.integers(0, 20, n)] + 0.1 * rng.normal(size=(n, 6))).round(3)


@pytest.mark.parametrize("threshold", [-1.0, 0.3, 0.9])
def test_recall_over_several_shelves(spark, monkeypatch, threshold):
    monkeypatch.setattr(M, "SHELF_VALUES", 6 * 40)
    rng = np.random.default_rng(6)
    records = [("/big", f"m{i:03d}", [float(x) for x in v]) for i, v in enumerate(clustered(rng, 300))]
    records += [("/big", f"same{i}", records[0][2]) for i in range(90)] + [("/big", "zero", [0.0] * 6)]
    records += [("/mid", f"n{i:02d}", [float(x) for x in v]) for i, v in enumerate(clustered(rng, 30))] + [("/small", "s", [1.0] * 6)]
    spaces = ["/big"] * 100 + ["/mid"] * 60 + ["/small", "/none"]
    queries = [(i, s, [float(x) for x in v]) for i, (s, v) in enumerate(zip(spaces, clustered(rng, len(spaces)), strict=True))]
    queries.append((500, "/big", [0.0] * 6))
    asked = spark.createDataFrame(queries, "query_id BIGINT, namespace STRING, embedding ARRAY<FLOAT>")
    stored = spark.createDataFrame(records, "namespace STRING, record_id STRING, embedding ARRAY<FLOAT>")
    found = M.recall_in_namespace(asked, stored, 3, threshold, 8)
    got = {(r["query_id"], r["namespace"], r["record_id"], r["score"] + 0.0, r["rank"]) for r in found.collect()}
    assert got == brute_recall(queries, records, 3, threshold)


def test_a_part_without_records_has_no_blocks():
    kinds = pa.schema([("namespace", pa.string()), ("_length", pa.int32()), ("record_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])
    pivots = pa.table({"_pivots": [[[1.0, 0.0], [0.0, 1.0]]]})
    assert M._nearest_pivot(kinds.empty_table(), pivots).num_rows == 0


def test_recall_does_not_repeat_vectors_for_every_block(spark):
    """Random vectors, for which no block can be left out: each is stored a few times at most."""
    rng = np.random.default_rng(7)
    vectors = lambda n: [[float(x) for x in v] for v in rng.normal(size=(n, 8))]
    records = [("/big", i, v) for i, v in enumerate(vectors(400))]
    queries = [(i, "/big", v) for i, v in enumerate(vectors(300))]
    home = f"{spark.conf.get('spark.checkpoint.dir')}/tallyline"
    before = set(glob.glob(f"{home}/stored-*"))
    found = M.recall_in_namespace(
        spark.createDataFrame(queries, "query_id BIGINT, namespace STRING, embedding ARRAY<FLOAT>"),
        spark.createDataFrame(records, "namespace STRING, record_id BIGINT, embedding ARRAY<FLOAT>"),
        3, -1.0, 4,
    )
    assert found.count() == 900
    kept = set(glob.glob(f"{home}/stored-*")) - before
    assert sum(spark.read.parquet(x).count() for x in kept) <= 3 * (len(records) + len(queries))


def test_vectors_of_other_lengths_do_not_meet(spark):
    queries = spark.createDataFrame([(1, "n", [1.0, 0.0]), (2, "n", [])], "query_id INT, namespace STRING, embedding ARRAY<FLOAT>")
    records = [("n", "a", [1.0, 0.0]), ("n", "b", [1.0, 0.0, 0.0]), ("n", "c", [1.0]), ("n", "d", [1.0, None]), ("n", "e", None)]
    found = M.recall_in_namespace(queries, spark.createDataFrame(records, "namespace STRING, record_id STRING, embedding ARRAY<FLOAT>"))
    assert [(r["query_id"], r["record_id"]) for r in found.collect()] == [(1, "a")]


def test_agent_events(spark):
    events = [("a", 0, '"He"'), ("a", 1, '""'), ("a", 2, '{"x": 1}'), ("a", 3, "5"), ("a", 4, None), ("a", 5, '"y"')]
    rows = A.text_deltas(spark.createDataFrame(events, "request_id STRING, seq BIGINT, data STRING")).collect()
    assert sorted((r["seq"], r["text"]) for r in rows) == [(0, "He"), (5, "y")]


def test_namespaces_of_an_actor(spark):
    query = spark.createDataFrame([(1, "ann", "s9", [1.0])], "query_id INT, actor_id STRING, session_id STRING, embedding ARRAY<FLOAT>")
    assert {r["namespace"] for r in M.actor_namespaces(query).collect()} == {
        "/facts/ann",
        "/preferences/ann",
        "/summaries/ann/s9",
    }


def test_feed(spark):
    at = datetime.datetime(2025, 1, 1)
    decided = spark.createDataFrame(
        [("u", "1", at, 3, 4, True, 90, None, None, 0.1), ("u", "2", at, 3, 4, False, None, 429, "over", 0.1)],
        "user_id STRING, request_id STRING, ts TIMESTAMP, tokens_in INT, tokens_out INT, accepted BOOLEAN, "
        "remaining BIGINT, code INT, message STRING, cost_usd DOUBLE",
    )
    deltas = spark.createDataFrame([("1", 0, "a"), ("1", 1, "b"), ("2", 0, "c")], "request_id STRING, seq BIGINT, text STRING")
    feed = A.out_events(deltas, decided).orderBy("ts", "request_id", "step", "seq").collect()
    assert [(r["request_id"], r["type"], r["text"], r["tokens_in"], r["code"]) for r in feed] == [
        ("1", "token", "a", None, None),
        ("1", "token", "b", None, None),
        ("1", "done", None, 3, None),
        ("2", "error", None, None, 429),
    ]
    assert {r["channel"] for r in feed} == {"/chat/u/stream"}
