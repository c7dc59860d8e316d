"""Model answers: event streams to text, clean-up, batching, token usage, the output feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.prefix import in_pages
from tallyline.functions.skew import sequence_slice
from tallyline.functions.text import BROWSER_SPACE, SERVER_SPACE, decode_lenient, trim_all

# Publish batch size, stream line prefix, code fences.
BATCH_EVENTS = 5
DATA_PREFIX = "data:"
FENCE_OPEN = "```python"
FENCE = "```"


def text_deltas(model_events: DataFrame) -> DataFrame:
    """Model events (request_id, seq, contentBlockDelta, metadata) to non-empty text deltas.

    Agent events, which have their text as `data` (JSON text of any value), give it where it is
    a string; a table may hold either form or both.
    """
    forms = [c for c in ("contentBlockDelta", "data") if c in model_events.columns]
    texts = {"contentBlockDelta": lambda: F.col("contentBlockDelta.delta.text"), "data": agent_text}
    text = F.coalesce(*[F.nullif(texts[c](), F.lit("")) for c in forms])
    return model_events.withColumn("_text", text).filter(F.col("_text").isNotNull()).select(
        *[c for c in model_events.columns if c not in ("contentBlockDelta", "metadata", "data")],
        F.col("_text").alias("text"),
    )


def agent_text() -> Column:
    """The `data` of an agent event if it is a JSON string, else NULL."""
    value = F.try_parse_json("data")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def answer_text(answer: Column) -> Column:
    """Join the `data:` lines of an event-stream answer; other answers stay as they are."""
    lines = F.filter(F.split(answer, "\n"), lambda line: line.startswith(DATA_PREFIX))
    parts = F.transform(
        lines, lambda line: trim_all(F.substring(line, len(DATA_PREFIX) + 1, 2147483647), BROWSER_SPACE)
    )
    return F.when(answer.contains(DATA_PREFIX), F.array_join(parts, "")).otherwise(answer)


def code_text(answer: Column) -> Column:
    """A code answer without markdown fences."""
    bare = F.replace(F.replace(answer, F.lit(FENCE_OPEN), F.lit("")), F.lit(FENCE), F.lit(""))
    return trim_all(bare, SERVER_SPACE)


def clean_answers(answers: DataFrame) -> DataFrame:
    """Add `clean` to answers (raw as text or bytes, is_code): decoded, joined, unfenced."""
    raw = F.col("raw")
    if dict(answers.dtypes)["raw"] == "binary":
        raw = decode_lenient(raw)
    return answers.withColumn("clean", F.when(F.col("is_code"), code_text(raw)).otherwise(answer_text(raw)))


def answer_parts(deltas: DataFrame, part_events: int = 1024, key: str = "request_id") -> DataFrame:
    """Text of each request in parts of `part_events` sequence numbers, each part whole.

    The parts of one request in `part` order are the answer; no part depends on how long
    the whole answer is.
    """
    return (
        deltas.withColumn("part", sequence_slice("seq", part_events))
        .groupBy(key, "part")
        .agg(_joined("seq", "text").alias("text"), F.count(F.lit(1)).alias("deltas"))
    )


def reassemble_answer(deltas: DataFrame, part_events: int = 1024, key: str = "request_id") -> DataFrame:
    """The text of each request: its deltas joined in sequence order, built from its parts."""
    return (
        answer_parts(deltas, part_events, key)
        .groupBy(key)
        .agg(_joined("part", "text").alias("answer"), F.sum("deltas").alias("deltas"))
    )


def _joined(order: str, text: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(ordered, lambda p: p["t"]), "")


def chunk_batches(
    deltas: DataFrame, size: int = BATCH_EVENTS, key: str = "request_id", parts: int | None = None
) -> DataFrame:
    """Pack each request's deltas, in order, into batches of `size`; the last may be shorter."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda e: e["text"])
    return in_pages(deltas, [key], ["seq"], "batch", size, texts.alias("texts"), parts=parts)


def final_usage(requests: DataFrame, model_events: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests with the token counts of their last usage event; 0 where there is none."""
    usage = F.col("metadata.usage")
    last = (
        model_events.filter(F.col("metadata").isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct("seq", usage.alias("usage")))["usage"].alias("_usage"))
    )
    return (
        requests.join(last, key, "left")
        .withColumn("tokens_in", F.coalesce("_usage.inputTokens", F.lit(0)))
        .withColumn("tokens_out", F.coalesce("_usage.outputTokens", F.lit(0)))
        .drop("_usage")
    )


def out_events(deltas: DataFrame, decided: DataFrame, key: str = "request_id") -> DataFrame:
    """The events sent back: tokens, errors and done events, one feed per tenant channel.

    `decided` holds one row per request (user_id, request_id, ts, tokens_in, tokens_out,
    accepted, remaining, code, message, cost_usd) and is read twice, so pass a stored table;
    `deltas` the text (request_id, seq, text). A rejected request gives one error and no
    tokens. A channel is read in the order ts, request_id, step, seq. `key` is the column
    that tells requests apart, in both tables: `prompt_id` for routed prompts, which may share
    a request id; it then is in the feed and orders it too.
    """
    accepted = F.col("accepted")
    names = list(dict.fromkeys(["request_id", key]))
    tokens = deltas.select(key, "seq", "text").join(decided.filter(accepted).select(*names, "user_id", "ts"), key)
    tokens = tokens.select(*names, "user_id", "ts", "seq", "text", F.lit("token").alias("type"), F.lit(0).alias("step"))
    ends = decided.select(
        *names,
        "user_id",
        "ts",
        F.when(accepted, "done").otherwise("error").alias("type"),
        F.lit(1).alias("step"),
        "code",
        "message",
        *[F.when(accepted, F.col(c)).alias(c) for c in ("tokens_in", "tokens_out", "cost_usd", "remaining")],
    )
    channel = F.concat(F.lit("/chat/"), "user_id", F.lit("/stream"))
    return tokens.unionByName(ends, allowMissingColumns=True).withColumn("channel", channel).drop("user_id")
