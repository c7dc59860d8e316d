"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

INVOICES = "invoice_id STRING, customer_name STRING, invoice_date DATE, amount DECIMAL(18,2), status STRING"
FILES = "name STRING, content STRING"
MODEL_EVENT = (
    "contentBlockDelta STRUCT<delta: STRUCT<text: STRING>>, "
    "metadata STRUCT<usage: STRUCT<inputTokens: INT, outputTokens: INT>>"
)
PUBLISH = (
    "path STRING, sub STRING, invocation_id STRING, "
    "events ARRAY<STRUCT<payload: STRUCT<prompt: STRING, request_id: STRING>>>"
)
CHAT_BODY = "prompt STRING, actor_id STRING, session_id STRING"
PUBLISH_EVENT = (
    "info STRUCT<channel: STRUCT<path: STRING>>, identity STRUCT<claims: STRUCT<sub: STRING>>, "
    "events ARRAY<STRUCT<payload: STRUCT<prompt: STRING, request_id: STRING>>>"
)
ORDER_BODY = "item STRING, amount DECIMAL(38,12), customer_email STRING"

# The nine columns of a usage record.
USAGE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("tokens_in", T.IntegerType()),
        T.StructField("tokens_out", T.IntegerType()),
        T.StructField("total_tokens", T.IntegerType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("latency_ms", T.IntegerType()),
        T.StructField("ts", T.StringType()),
    ]
)
COUNTERS = (
    "user_id STRING, period STRING, total_tokens BIGINT, tokens_in BIGINT, tokens_out BIGINT, "
    "requests BIGINT, expires_at TIMESTAMP"
)
