"""Usage metering: prompt routing, admission, records, counters and the cost report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.compute import once
from tallyline.functions.defaults import if_empty, if_missing
from tallyline.functions.prefix import SLICE, SPLIT, Cuts, cut, per_slice, slice_window, sliced
from tallyline.functions.skew import same_key_join
from tallyline.schemas import CHAT_BODY, ORDER_BODY, PUBLISH_EVENT

# Defaults and formats the metered service is defined by.
PRICE_IN_PER_1K = 0.0008
PRICE_OUT_PER_1K = 0.004
MONTHLY_TOKEN_LIMIT = 100_000
COUNTER_DAYS = 90
PERIOD_FORMAT = "yyyy-MM"
PROMPT_SUFFIX = "/prompt"
ANONYMOUS = "anonymous"
LIMIT_CODE = 429
LIMIT_MESSAGE = "Monthly token limit reached (%s/%s)."
ORDER_ITEM = "(unspecified)"

TENANT_MONTH = ["user_id", "period"]


def period_of(ts: Column | str) -> Column:
    """Calendar month of a timestamp as text (the session time zone should be UTC)."""
    return F.date_format(ts, PERIOD_FORMAT)


def _tokens(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def route_prompts(publishes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split publishes into one row per prompt, and the publishes of other channels as they are.

    Only channels ending in the prompt suffix are prompts, so the service's own output on
    the stream channel never re-enters. A publish without events gives no prompt. Prompts of
    one publish may share a request id; `prompt_id`, from the invocation and the place in the
    publish, is the key that later steps use.
    """
    is_prompt = F.coalesce(F.col("path").endswith(PROMPT_SUFFIX), F.lit(False))
    user = if_missing(F.col("sub"), ANONYMOUS)
    prompts = (
        publishes.filter(is_prompt)
        .select(
            *[c for c in publishes.columns if c not in ("path", "sub", "invocation_id", "events")],
            user.alias("user_id"),
            "invocation_id",
            F.posexplode("events").alias("event_no", "event"),
        )
        .withColumn("request_id", if_missing(F.col("event.payload.request_id"), F.col("invocation_id")))
        .withColumn("prompt", if_missing(F.col("event.payload.prompt"), ""))
        .withColumn("prompt_id", F.concat(F.coalesce("invocation_id", F.lit("")), F.lit("#"), "event_no"))
        .withColumn("out_channel", F.concat(F.lit("/chat/"), "user_id", F.lit("/stream")))
        .drop("event", "invocation_id")
    )
    return prompts, publishes.filter(~is_prompt)


def parse_publishes(raw: DataFrame, event: str = "event") -> DataFrame:
    """Publish events as JSON text to the columns of `PUBLISH`; other columns are kept.

    The channel is `info.channel.path`, the publisher `identity.claims.sub` and the prompts
    `events[].payload`. Text that is not a JSON object gives a publish without channel, which
    is no prompt.
    """
    kept = [c for c in raw.columns if c != event]
    parsed = raw.withColumn("_p", once(F.from_json(event, PUBLISH_EVENT)))
    return parsed.select(
        *kept,
        F.col("_p.info.channel.path").alias("path"),
        F.col("_p.identity.claims.sub").alias("sub"),
        F.col("_p.events").alias("events"),
    )


def normalize_requests(
    raw: DataFrame, kind: str, live: bool = False, key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """JSON bodies of chat turns (`chat`) or new orders (`order`) to typed rows with defaults.

    `raw` has `body` and any other columns, which are kept. Absent ids are made from a hash
    of `key`, columns that name one input row (file and offset, or a log sequence), so a re-run
    gives the same ids and equal bodies get different ones; `live` makes random ids instead.
    Amounts keep their digits. Bodies that are not JSON objects come back as the second result.
    """
    if not live and not key:
        raise ValueError("name the columns that identify an input row, or ask for live ids")
    schema = {"chat": CHAT_BODY, "order": ORDER_BODY}[kind]
    kept = [c for c in raw.columns if c != "body"]
    new_id = F.uuid() if live else F.sha2(F.to_json(F.struct(*key)), 256)
    options = {"columnNameOfCorruptRecord": "_bad"}
    parsed = raw.withColumn(
        "_b", once(F.from_json(if_empty(F.col("body"), "{}"), f"{schema}, _bad STRING", options))
    )
    is_bad = F.col("_b").isNull() | F.col("_b._bad").isNotNull()
    rejects = parsed.filter(is_bad).select(*raw.columns)
    good = parsed.filter(~is_bad)
    if kind == "chat":
        columns = [
            if_missing(F.col("_b.prompt"), "").alias("prompt"),
            if_missing(F.col("_b.actor_id"), ANONYMOUS).alias("actor_id"),
            if_empty(F.col("_b.session_id"), new_id).alias("session_id"),
        ]
    else:
        columns = [
            new_id.alias("order_id"),
            if_missing(F.col("_b.item"), ORDER_ITEM).alias("item"),
            if_missing(F.col("_b.amount"), F.lit(0).cast("decimal(38,12)")).alias("amount"),
            if_missing(F.col("_b.customer_email"), "").alias("customer_email"),
        ]
    return good.select(*kept, *columns), rejects


def cost_of(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    return F.round(tokens_in / 1000 * price_in + tokens_out / 1000 * price_out, 6)


def usage_records(
    requests: DataFrame,
    model_id: str,
    price_in: float = PRICE_IN_PER_1K,
    price_out: float = PRICE_OUT_PER_1K,
) -> DataFrame:
    """Finished requests (user_id, request_id, started, ended, tokens_in/out) to usage records."""
    t_in, t_out = _tokens("tokens_in").cast("int"), _tokens("tokens_out").cast("int")
    return requests.select(
        "user_id",
        "request_id",
        F.lit(model_id).alias("model_id"),
        t_in.alias("tokens_in"),
        t_out.alias("tokens_out"),
        (t_in + t_out).alias("total_tokens"),
        cost_of(t_in, t_out, price_in, price_out).alias("cost_usd"),
        F.expr("cast((unix_micros(ended) - unix_micros(started)) div 1000 as int)").alias("latency_ms"),
        F.col("ended").alias("ts"),
        period_of("ended").alias("period"),
        F.to_date("ended").alias("dt"),
    )


def ttl_filter(
    df: DataFrame, as_of: Column, ttl_days: int, keys: list[str] | None = None, ts: str = "ts"
) -> DataFrame:
    """Rows still alive at `as_of`: `ttl_days` after their own time, or, with `keys`, after
    the first write of their key. A table that already has `expires_at` is filtered on it."""
    ttl = F.make_dt_interval(days=F.lit(ttl_days))
    if "expires_at" in df.columns:
        return df.filter(F.col("expires_at") > as_of)
    if not keys:
        return df.filter(F.col(ts) > as_of - ttl)
    first = df.groupBy(*keys).agg(F.min(ts).alias("_first"))
    return df.join(first.filter(F.col("_first") > as_of - ttl).select(*keys), keys, "left_semi")


def current_usage(requests: DataFrame, counters: DataFrame) -> DataFrame:
    """Each request with the tokens its tenant has used in the request's month, 0 if none."""
    used = counters.select(*TENANT_MONTH, F.col("total_tokens").alias("used"))
    return (
        requests.withColumn("period", period_of("ts"))
        .join(used, TENANT_MONTH, "left")
        .withColumn("used", F.coalesce("used", F.lit(0)).cast("bigint"))
    )


def budget_admission(
    requests: DataFrame,
    limit: int = MONTHLY_TOKEN_LIMIT,
    opening: DataFrame | None = None,
    key: str = "request_id",
    parts: int | None = None,
) -> DataFrame:
    """Accept or reject each request (user_id, request_id, ts, tokens_in, tokens_out) in order.

    A request is rejected once the tokens of the accepted requests before it reach `limit`;
    the last accepted one may overshoot. Because token counts are never negative, the sum
    over *all* earlier requests reaches the limit exactly when the accepted sum does, so a
    running sum decides. `opening` (user_id, period, used) holds tokens charged before.
    Requests of one time are ordered by `key`, which must tell them apart: `prompt_id` for
    routed prompts. Requests without a tenant are those of one tenant. Sums are carried over
    the ranges of a tenant-month (`functions.prefix`); `parts` sets the number of ranges.
    """
    order = ["ts", key]
    rows = requests.withColumn("period", period_of("ts")).withColumn(
        "_tokens", _tokens("tokens_in") + _tokens("tokens_out")
    )
    cuts = cut(rows, TENANT_MONTH, order, uses=("_tokens",), parts=parts, _earlier=(F.sum("_tokens"), F.sum))
    placed = sliced(rows, cuts)
    if opening is None:
        placed = placed.withColumn("_used", F.lit(0).cast("bigint"))
    else:
        used = opening.select(*TENANT_MONTH, F.col("used").cast("bigint").alias("_used"))
        placed = same_key_join(placed, per_slice(used, cuts), [*TENANT_MONTH, SLICE], "left")
    placed = placed.withColumn("_used", F.coalesce("_used", F.lit(0))).withColumn(
        "_base", F.col("_used") + F.coalesce("_earlier", F.lit(0))
    )
    placed = _with_stops(placed, cuts, limit)
    before = slice_window(cuts).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    limit_ = F.lit(limit).cast("bigint")
    total_then = F.when(F.col("accepted"), F.col("_before") + F.col("_tokens"))
    return (
        placed.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_tokens").over(before), F.lit(0)))
        .withColumn("accepted", F.col("_before") < limit_)
        .withColumn("_reached", F.max(total_then).over(before))
        .withColumn(
            "used",
            F.when(F.col("accepted"), F.col("_before")).otherwise(F.coalesce("_reached", "_stop", "_used")),
        )
        .select(
            *requests.columns,
            "period",
            "accepted",
            "used",
            F.when(
                F.col("accepted"), F.greatest(F.lit(0), limit_ - F.col("used") - F.col("_tokens"))
            ).alias("remaining"),
            F.when(~F.col("accepted"), F.lit(LIMIT_CODE)).alias("code"),
            F.when(~F.col("accepted"), F.format_string(LIMIT_MESSAGE, "used", limit_)).alias("message"),
        )
    )


def _with_stops(placed: DataFrame, cuts: Cuts, limit: int) -> DataFrame:
    """Add `_stop`, the total at which a tenant-month of several ranges stopped in an earlier one.

    It stops in one range, known from the carried sums, whose rows are looked at once more.
    """
    if cuts.table is None:
        return placed.withColumn("_stop", F.lit(None).cast("bigint"))
    through = slice_window(cuts).rowsBetween(Window.unboundedPreceding, 0)
    stops = (
        placed.filter(F.col(SPLIT) & (F.col("_base") < limit) & (F.col("_base") + F.col("_earlier_own") >= limit))
        .withColumn("_total", F.col("_base") + F.sum("_tokens").over(through))
        .filter(F.col("_total") >= limit)
        .groupBy(*TENANT_MONTH)
        .agg(F.min("_total").alias("_stop"))
    )
    # no more rows than keys that span ranges
    return same_key_join(placed, F.broadcast(stops), TENANT_MONTH, "left")


def usage_counters(accepted: DataFrame, counter_days: int = COUNTER_DAYS) -> DataFrame:
    """Per tenant and month: token totals, request count and the expiry after the first write."""
    return (
        accepted.withColumn("period", period_of("ts"))
        .groupBy(*TENANT_MONTH)
        .agg(
            F.sum(_tokens("tokens_in") + _tokens("tokens_out")).alias("total_tokens"),
            F.sum(_tokens("tokens_in")).alias("tokens_in"),
            F.sum(_tokens("tokens_out")).alias("tokens_out"),
            F.count(F.lit(1)).alias("requests"),
            (F.min("ts") + F.make_dt_interval(days=F.lit(counter_days))).alias("expires_at"),
        )
    )


def usage_report(usage: DataFrame) -> DataFrame:
    """Tokens, cost and requests per tenant, most expensive first.

    The per-request costs have six places, so they are added exactly as decimals.
    """
    return (
        usage.groupBy("user_id")
        .agg(
            F.sum("total_tokens").cast("bigint").alias("tokens"),
            F.sum(F.col("cost_usd").cast("decimal(18,6)")).cast("double").alias("cost_usd"),
            F.count(F.lit(1)).alias("requests"),
        )
        .orderBy(F.desc_nulls_last("cost_usd"), "user_id")
    )
