"""Queries of model answers, files and memory."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import answers as A
from tallyline.operators import files as FI
from tallyline.operators import memory as M
from tallyline.plans import views as V
from tallyline.plans.common import plain, work_dir
from tallyline.sources import folder

WORDS_SQL = """turns AS (
  SELECT concat(conv_id, '-', turn) AS request_id, turn, text, string_split(text, ' ') AS words FROM conversations),
word AS (SELECT request_id, unnest(range(len(words))) AS seq, unnest(words) AS w FROM turns),
deltas AS (
  SELECT request_id, seq, CASE WHEN seq = 0 THEN w ELSE concat(' ', w) END AS text FROM word
  WHERE seq > 0 OR w <> '')"""


def text_deltas(spark, sf):
    return plain(A.text_deltas(V.model_events(spark, sf)))


def reassemble_answer(spark, sf):
    return plain(A.reassemble_answer(A.text_deltas(V.model_events(spark, sf)), 64))


def answer_parts(spark, sf):
    return plain(A.answer_parts(A.text_deltas(V.model_events(spark, sf)), 64))


def _batches(spark, sf, **options):
    batches = A.chunk_batches(A.text_deltas(V.model_events(spark, sf)), **options)
    return plain(batches.select("request_id", "batch", F.array_join("texts", "|").alias("texts")))


def chunk_batches(spark, sf):
    return _batches(spark, sf)


def chunk_batches_sliced(spark, sf):
    return _batches(spark, sf, parts=40)


def final_usage(spark, sf):
    return plain(A.final_usage(V.answer_requests(spark, sf), V.model_events(spark, sf)))


def clean_answers(spark, sf):
    """Turns as event streams (every fifth one plain), and all of them as fenced code."""
    turns = V.table(spark, sf, "conversations")
    stream = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.col("text")).otherwise(
        F.concat(F.lit("data: "), F.replace("text", F.lit("\n"), F.lit("\ndata: ")))
    )
    code = F.concat(F.lit("```python\n"), "text", F.lit("\n```"))
    both = turns.select(
        "conv_id",
        "turn",
        F.explode(
            F.array(
                F.struct(stream.alias("raw"), F.lit(False).alias("is_code")),
                F.struct(code.alias("raw"), F.lit(True).alias("is_code")),
            )
        ).alias("a"),
    ).select("conv_id", "turn", "a.*")
    return A.clean_answers(both).drop("raw")


def clean_bytes(spark, sf):
    """Whole documents as bytes, cleaned as code answers."""
    docs = V.table(spark, sf, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("raw"), F.lit(True).alias("is_code")
    )
    return A.clean_answers(docs).drop("raw", "is_code")


def _ops(spark, sf):
    return FI.file_ops_normalize(V.file_requests(spark, sf))


def file_ops_normalize(spark, sf):
    return plain(_ops(spark, sf))


def file_log_compact(spark, sf):
    return plain(FI.file_log_compact(_ops(spark, sf)))


def file_op_status(spark, sf):
    return plain(FI.file_op_status(_ops(spark, sf)))


def file_op_status_sliced(spark, sf):
    return plain(FI.file_op_status(_ops(spark, sf), parts=40))


def _stored(spark, sf) -> str:
    """A folder holding the files the whole request log leaves behind; its first part was
    applied before, so some files have to go again."""
    path = work_dir(spark, "files")
    ops = _ops(spark, sf)
    folder.apply_log(ops.filter("seq < 500"), path)
    folder.apply_log(ops, path)
    return path


def put_files(spark, sf):
    """The written files, measured by reading them back."""
    path = _stored(spark, sf)
    read = folder.read_files(path, folder.list_files(spark, path).select("name"))
    return plain(read.select("name", F.length("content").alias("size")))


def list_files(spark, sf):
    return folder.list_files(spark, _stored(spark, sf)).drop("folder")


def read_files(spark, sf):
    names = _ops(spark, sf).filter("name IS NOT NULL").select("name").distinct()
    return folder.read_files(_stored(spark, sf), names)


def _records(spark, sf):
    no = F.col("vec_id")
    space = (
        F.when(no % 3 == 0, F.concat(F.lit("/facts/"), "label"))
        .when(no % 3 == 1, F.concat(F.lit("/preferences/"), "label"))
        .otherwise(F.concat(F.lit("/summaries/"), "label", F.lit("/s"), no % 4))
    )
    return V.table(spark, sf, "embeddings").select(space.alias("namespace"), no.alias("record_id"), "embedding")


def _recall(spark, sf, **options):
    queries = V.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"),
        F.col("label").cast("string").alias("actor_id"),
        F.concat(F.lit("s"), F.col("vec_id") % 4).alias("session_id"),
        "embedding",
    )
    return plain(M.memory_recall(queries, _records(spark, sf), **options))


def memory_recall(spark, sf):
    return _recall(spark, sf)


def memory_recall_wide(spark, sf):
    return _recall(spark, sf, threshold=0.1, block_rows=16)


def topk_per_namespace(spark, sf):
    """The three largest vectors of each label by their first coordinate."""
    scored = V.table(spark, sf, "embeddings").select(
        "label", "vec_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("score")
    )
    return plain(M.topk_per_namespace(scored, ["label"], [F.desc("score"), F.asc("vec_id")], 3))


OPS_SQL = """ops AS (
  SELECT event_id AS seq, ts,
         CASE event_type WHEN 'purchase' THEN 'PUT' WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'POST' ELSE 'GET' END AS method,
         CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '..'
              ELSE concat(CASE WHEN event_id % 11 = 0 THEN '.' ELSE '' END, 'f', user_id, '_', event_id % 5) END AS name,
         CASE WHEN event_type <> 'purchase' OR (event_id % 13 = 0 AND event_id % 9 <> 0)
                   OR (event_id % 22 = 0 AND strlen(props) % 3 <> 0) THEN NULL
              WHEN event_id % 2 = 0 OR event_id % 3 <> 0 THEN props ELSE '' END AS content
  FROM events)"""
STORED_SQL = f"""{OPS_SQL}, stored AS (
  SELECT name, content, seq, method FROM ops WHERE name IS NOT NULL AND (content IS NOT NULL OR method = 'DELETE')
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1), files AS (
  SELECT name, content, seq FROM stored WHERE method = 'PUT')"""
STATUS_SQL = f"""WITH {OPS_SQL}, replay AS (
  SELECT *, last_value(CASE WHEN content IS NOT NULL OR method = 'DELETE' THEN method END IGNORE NULLS)
         OVER (PARTITION BY name ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM ops)
SELECT seq, ts, method, name, length(content) AS size,
       cast(CASE WHEN method = 'GET' AND name IS NULL THEN 200
            WHEN method IN ('GET', 'DELETE') AND name IS NOT NULL THEN CASE WHEN last = 'PUT' THEN 200 ELSE 404 END
            WHEN method = 'PUT' AND name IS NOT NULL THEN CASE WHEN content IS NULL THEN 500 ELSE 201 END ELSE 400 END AS bigint) AS status FROM replay"""
BATCHES_SQL = f"""WITH {WORDS_SQL}, placed AS (
  SELECT *, (row_number() OVER (PARTITION BY request_id ORDER BY seq) - 1) // 5 AS batch FROM deltas)
SELECT request_id, batch, string_agg(text, '|' ORDER BY seq) AS texts FROM placed GROUP BY request_id, batch"""


def recall_sql(threshold: float) -> str:
    return f"""WITH rec AS (
  SELECT vec_id AS record_id, embedding, CASE vec_id % 3 WHEN 0 THEN concat('/facts/', label)
         WHEN 1 THEN concat('/preferences/', label) ELSE concat('/summaries/', label, '/s', vec_id % 4) END AS namespace
  FROM embeddings),
asked AS (
  SELECT vec_id AS query_id, embedding, unnest([concat('/facts/', label), concat('/preferences/', label),
         concat('/summaries/', label, '/s', vec_id % 4)]) AS namespace FROM embeddings),
scored AS (
  SELECT a.query_id, a.namespace, r.record_id,
         round(list_cosine_similarity(cast(a.embedding AS double[]), cast(r.embedding AS double[])), 6) AS score
  FROM asked a JOIN rec r ON r.namespace = a.namespace),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, namespace ORDER BY score DESC, record_id) AS rank
  FROM scored WHERE score >= {threshold})
SELECT * FROM ranked WHERE rank <= 3"""


QUERIES = {
    "text_deltas": (text_deltas, f"WITH {WORDS_SQL} SELECT * FROM deltas"),
    "reassemble_answer": (
        reassemble_answer,
        f"""WITH {WORDS_SQL}, n AS (SELECT request_id, count(*) AS deltas FROM deltas GROUP BY request_id)
SELECT t.request_id, t.text AS answer, n.deltas FROM turns t JOIN n ON n.request_id = t.request_id""",
    ),
    "answer_parts": (
        answer_parts,
        f"""WITH {WORDS_SQL}
SELECT request_id, seq // 64 AS part, string_agg(text, '' ORDER BY seq) AS text, count(*) AS deltas
FROM deltas GROUP BY request_id, seq // 64""",
    ),
    "chunk_batches": (chunk_batches, BATCHES_SQL),
    "chunk_batches_sliced": (chunk_batches_sliced, BATCHES_SQL),
    "final_usage": (
        final_usage,
        f"""WITH {WORDS_SQL}
SELECT request_id, len(words) AS tokens_in, CASE WHEN turn % 2 = 1 THEN len(words) * 2 ELSE 0 END AS tokens_out FROM turns
UNION ALL SELECT concat(conv_id, '-none'), 0, 0 FROM conversations WHERE turn = 0""",
    ),
    "clean_answers": (
        clean_answers,
        r"""SELECT conv_id, turn, false AS is_code, CASE WHEN (conv_id + turn) % 5 = 0 THEN text ELSE
  array_to_string(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), '') END AS clean
FROM conversations
UNION ALL SELECT conv_id, turn, true, regexp_replace(text, '^\s+|\s+$', '', 'g') FROM conversations""",
    ),
    "clean_bytes": (
        clean_bytes,
        r"""SELECT doc_id, regexp_replace(replace(replace(text, '```python', ''), '```', ''), '^\s+|\s+$', '', 'g') AS clean
FROM documents""",
    ),
    "file_ops_normalize": (
        file_ops_normalize,
        f"WITH {OPS_SQL} SELECT *, length(content) AS size FROM ops",
    ),
    "file_log_compact": (file_log_compact, f"WITH {STORED_SQL} SELECT * FROM files"),
    "file_op_status": (file_op_status, STATUS_SQL),
    "file_op_status_sliced": (file_op_status_sliced, STATUS_SQL),
    "put_files": (put_files, f"WITH {STORED_SQL} SELECT name, length(content) AS size FROM files"),
    "list_files": (
        list_files,
        f"WITH {STORED_SQL} SELECT name, octet_length(encode(content)) AS bytes FROM files ORDER BY name",
    ),
    "read_files": (
        read_files,
        f"""WITH {STORED_SQL}, names AS (SELECT DISTINCT name FROM ops WHERE name IS NOT NULL)
SELECT n.name, f.content, f.name IS NOT NULL AS found FROM names n LEFT JOIN files f ON f.name = n.name""",
    ),
    "memory_recall": (memory_recall, recall_sql(0.5)),
    "memory_recall_wide": (memory_recall_wide, recall_sql(0.1)),
    "topk_per_namespace": (
        topk_per_namespace,
        """WITH s AS (SELECT cast(label AS bigint) AS label, vec_id, round(cast(embedding[1] AS double), 6) AS score FROM embeddings)
SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s
QUALIFY rank <= 3""",
    ),
}
