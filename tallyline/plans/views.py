"""The driver tables reshaped into the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.usage import parse_publishes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests_from(events: DataFrame, months: bool = False) -> DataFrame:
    """Events as metered requests; with `months` the users are spread over three months."""
    ts = F.col("ts").cast("timestamp")
    if months:
        ts = ts + F.expr("make_dt_interval(cast(user_id % 3 * 31 as int))")
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("request_id"),
        ts.alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("tokens_in"),
        F.floor("value").cast("int").alias("tokens_out"),
    )


def requests(spark: SparkSession, sf_dir: str, months: bool = False) -> DataFrame:
    return requests_from(table(spark, sf_dir, "events"), months)


def finished(spark: SparkSession, sf_dir: str, months: bool = False) -> DataFrame:
    """Requests with start and end; the output tokens decide how long an answer took."""
    return (
        requests(spark, sf_dir, months)
        .withColumnRenamed("ts", "started")
        .withColumn("ended", F.expr("started + make_dt_interval(0, 0, 0, tokens_out / 100)"))
    )


_PAYLOAD = "struct<prompt: string, request_id: string>"
_EVENTS = f"array<struct<payload: {_PAYLOAD}>>"


def publishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one publish event, parsed from its JSON text: views are stream output,
    signups carry no prompt, purchases carry two (the second without payload, and every third
    one without request ids at all); some publishers are not signed in."""
    unnamed = (F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0)
    request = F.when(~unnamed, F.concat(F.lit("r"), "event_id"))
    prompt = F.struct(F.struct(F.col("props").alias("prompt"), request.alias("request_id")).alias("payload"))
    empty = F.struct(F.lit(None).cast(_PAYLOAD).alias("payload"))
    user = F.col("user_id").cast("string")
    path = F.concat(F.lit("/chat/"), user, F.when(F.col("event_type") == "view", "/stream").otherwise("/prompt"))
    sub = F.when(F.col("user_id") % 7 != 0, user)
    events = (
        F.when(F.col("event_type") == "signup", F.array().cast(_EVENTS))
        .when(F.col("event_type") == "purchase", F.array(prompt, empty))
        .otherwise(F.array(prompt))
    )
    event = F.struct(
        F.struct(F.struct(path.alias("path")).alias("channel")).alias("info"),
        F.struct(F.struct(sub.alias("sub")).alias("claims")).alias("identity"),
        events.alias("events"),
    )
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("i"), "event_id").alias("invocation_id"),
        F.to_json(event).alias("event"),
    )
    return parse_publishes(raw)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_name"),
        F.to_date("o_orderdate").alias("invoice_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


def id_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("invoice_id"))


def range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        key.alias("customer_name"),
        F.when(key % 3 != 0, F.when(key % 5 == 0, "").otherwise("1996-03-15")).alias("start_date"),
        F.when(key % 4 != 0, "1999-08-20").alias("end_date"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submissions_from(table(spark, sf_dir, "orders"))


def submissions_from(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("submitted")
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions_from(table(spark, sf_dir, "lineitem"))


def decisions_from(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("cb"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_linenumber").alias("line"),
        F.when(flag == "A", "approve").when(flag == "R", "reject").otherwise("other").alias("decision"),
    )


def decision_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approval log: some calls lack the callback id (or have it empty) or the decision."""
    key = F.col("l_orderkey").cast("string")
    cb = F.when(F.col("l_orderkey") % 7 == 0, "x=1").when(F.col("l_orderkey") % 13 == 0, "cb=").otherwise(
        F.concat(F.lit("cb="), key)
    )
    flag = F.col("l_returnflag")
    word = F.when(flag == "A", "approve").when(flag == "R", "reject").otherwise("Approve")
    tail = F.when(F.col("l_orderkey") % 11 == 0, "").otherwise(F.concat(F.lit("&decision="), word))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.concat(F.lit("https://h/p/approve?"), cb, tail).alias("url"),
    )


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        key.cast("string").alias("cb"),
        F.col("o_orderpriority").alias("item"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@x"))).alias(
            "customer_email"
        ),
    )


def file_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as file requests; every ninth lacks a name, some names begin with a dot or are
    no names of files, and some encoded bodies have foreign characters or lack their padding."""
    kind = F.col("event_type")
    no = F.col("event_id")
    dot = F.when(no % 11 == 0, ".").otherwise("")
    name = F.when(no % 13 == 0, "..").otherwise(
        F.concat(dot, F.lit("f"), F.col("user_id").cast("string"), F.lit("_"), (no % 5).cast("string"))
    )
    encoded = F.base64(F.col("props").cast("binary"))
    encoded = (
        F.when(no % 22 == 0, F.regexp_replace(encoded, "=+$", ""))
        .when(no % 14 == 0, F.concat(F.lit("%\n"), encoded, F.lit("*")))
        .otherwise(encoded)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "purchase", "PUT")
        .when(kind == "error", "DELETE")
        .when(kind == "signup", "POST")
        .otherwise("GET")
        .alias("method"),
        F.when(F.col("event_id") % 9 == 0, "/files/")
        .otherwise(F.concat(F.lit("/files//"), name, F.lit("/x")))
        .alias("path"),
        F.when(no % 2 == 0, encoded)
        .when(F.col("event_id") % 3 != 0, F.col("props"))
        .alias("body"),
        (F.col("event_id") % 2 == 0).alias("is_base64"),
    )


def model_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_events_from(table(spark, sf_dir, "conversations"))


def model_events_from(conversations: DataFrame) -> DataFrame:
    """Conversation turns as model event streams: a delta per word (with the blank before
    it), an empty delta, two usage events of which the last counts."""
    words = F.split("text", " ")
    n = F.size("_w")
    delta = F.transform(
        "_w",
        lambda w, i: F.struct(
            i.alias("seq"), F.when(i == 0, w).otherwise(F.concat(F.lit(" "), w)).alias("text"),
            F.lit(None).cast("int").alias("t_in"), F.lit(None).cast("int").alias("t_out"),
        ),
    )

    def event(seq, text, t_in, t_out):
        return F.struct(
            seq.alias("seq"),
            text.cast("string").alias("text"),
            t_in.cast("int").alias("t_in"),
            t_out.cast("int").alias("t_out"),
        )

    none = F.lit(None)
    extra = F.array(
        event(n, F.lit(""), none, none),
        event(n + 1, none, F.lit(1), F.lit(1)),
        event(n + 2, none, n, F.when(F.col("turn") % 2 == 1, n * 2)),
    )
    return (
        conversations.select("conv_id", "turn", words.alias("_w"))
        .select(
            F.concat("conv_id", F.lit("-"), "turn").alias("request_id"),
            F.explode(F.concat(delta, extra)).alias("e"),
        )
        .select(
            "request_id",
            F.col("e.seq").alias("seq"),
            F.when(
                F.col("e.text").isNotNull(),
                F.struct(F.struct(F.col("e.text").alias("text")).alias("delta")),
            ).alias("contentBlockDelta"),
            F.when(
                F.col("e.t_in").isNotNull(),
                F.struct(
                    F.struct(
                        F.col("e.t_in").alias("inputTokens"), F.col("e.t_out").alias("outputTokens")
                    ).alias("usage")
                ),
            ).alias("metadata"),
        )
    )


def answer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns as requests, and one more per conversation that never got an answer."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.select(F.concat("conv_id", F.lit("-"), "turn").alias("request_id"))
    unanswered = turns.filter("turn = 0").select(F.concat("conv_id", F.lit("-none")).alias("request_id"))
    return asked.unionByName(unanswered)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as trace spans, one minute apart; some have no actor."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session_id"),
        F.concat("conv_id", F.lit("-"), (F.col("turn") / 2).cast("int")).alias("request_id"),
        F.when(F.col("conv_id") % 9 != 0, F.concat(F.lit("a"), F.col("conv_id") % 20)).alias("actor_id"),
        F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(turn as int), 0)").alias("ts"),
    )


def session_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_requests_from(table(spark, sf_dir, "events"))


def session_requests_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("session_id"),
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def usage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_lines_from(requests(spark, sf_dir))


def usage_lines_from(requests: DataFrame) -> DataFrame:
    """Usage records as JSON lines, some of them broken or with a text for a number."""
    record = F.to_json(
        F.struct(
            "user_id",
            "request_id",
            F.lit("m").alias("model_id"),
            "tokens_in",
            "tokens_out",
            (F.col("tokens_in") + F.col("tokens_out")).alias("total_tokens"),
            F.col("ts").cast("string").alias("ts"),
        )
    )
    no = F.col("request_id").cast("bigint")
    return requests.select(
        F.when(no % 97 == 0, F.concat(F.lit("broken "), "request_id"))
        .when(no % 89 == 0, F.concat(F.lit('{"request_id":"'), "request_id", F.lit('","tokens_in":"many"}')))
        .otherwise(record)
        .alias("value")
    )


def event_time() -> Column:
    """A time for each model event: a second per sequence number."""
    return F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(seq as int))")
