"""Streaming text assembly: model events to finished answers and publish batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.answers import (
    BATCH_EVENTS,
    chunk_batches,
    final_usage,
    reassemble_answer,
    text_deltas,
)
from tallyline.schemas import MODEL_EVENT
from tallyline.streaming.versions import batch_folder, before_batch, start_batches, write_version

PENDING = f"request_id STRING, seq BIGINT, ts TIMESTAMP, {MODEL_EVENT}"


def stream_text_assembly(
    model_events: DataFrame,
    answers: str,
    batches: str,
    pending: str,
    checkpoint: str,
    delay: str = "1 hour",
    size: int = BATCH_EVENTS,
    trigger: dict | None = None,
):
    """Assemble a stream of model events (request_id, seq, ts, contentBlockDelta, metadata).

    A request is written when its usage event and all events before it (sequence numbers from
    0) have arrived: its text and tokens to `answers` and its publish batches to `batches`.
    Until then its events wait in `pending`; after `delay` of event time without news it is
    written as it is, with `complete` false, and what comes later goes to `<pending>-late`.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = before_batch(spark, pending, batch_id, PENDING)
        columns = waiting.columns
        # Requests given up are few; finished ones have had all their events.
        given_up = before_batch(spark, f"{pending}-given-up", batch_id, "request_id STRING")
        late = batch.join(given_up, "request_id", "left_semi").select(*columns)
        late.write.mode("overwrite").parquet(batch_folder(f"{pending}-late", batch_id))
        fresh = batch.join(given_up, "request_id", "left_anti")
        events = waiting.unionByName(fresh.select(*columns)).persist()
        try:
            assemble(spark, events, batch_id, given_up)
        finally:
            events.unpersist()

    def assemble(spark: SparkSession, events: DataFrame, batch_id: int, given_up: DataFrame) -> None:
        newest = events.agg(F.max("ts")).first()[0]
        done = (
            events.groupBy("request_id")
            .agg(
                F.max(F.when(F.col("metadata").isNotNull(), F.col("seq"))).alias("_end"),
                F.count_distinct("seq").alias("_events"),
                (F.max("ts") < F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")).alias("_stale"),
            )
            .withColumn("complete", F.coalesce(F.col("_events") > F.col("_end"), F.lit(False)))
            .filter("complete OR _stale")
            .select("request_id", "complete")
        )
        # Which requests are done is settled once and read back, so all three outputs agree.
        settled = batch_folder(f"{pending}-done", batch_id)
        done.write.mode("overwrite").parquet(settled)
        done = spark.read.schema("request_id STRING, complete BOOLEAN").parquet(settled)
        finished = events.join(done.select("request_id"), "request_id", "left_semi")
        deltas = text_deltas(finished)
        text = done.join(reassemble_answer(deltas), "request_id", "left").withColumn(
            "answer", F.coalesce("answer", F.lit(""))
        )
        final_usage(text, finished).write.mode("overwrite").parquet(batch_folder(answers, batch_id))
        chunk_batches(deltas, size).write.mode("overwrite").parquet(batch_folder(batches, batch_id))
        stale = done.filter("NOT complete").select("request_id")
        write_version(given_up.unionByName(stale), f"{pending}-given-up", batch_id)
        write_version(
            events.join(done.select("request_id"), "request_id", "left_anti").select(*events.columns), pending, batch_id
        )

    return start_batches(model_events, each, checkpoint, trigger)
