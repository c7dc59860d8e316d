"""Streaming sessions: activity windows and the resource registry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyline.streaming.versions import KEYED_STATE, stateful_start


def sessions(requests: DataFrame, gap: str, delay: str) -> DataFrame:
    """Activity sessions (session_id, start, end, requests) closed by an idle `gap`.

    `stream_sessions` starts it so that requests are merged into sessions before the shuffle.
    """
    return (
        requests.withWatermark("ts", delay)
        .groupBy("session_id", F.session_window("ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select("session_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "requests")
    )


def stream_sessions(
    requests: DataFrame,
    gap: str,
    delay: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partitions: int | None = None,
):
    """Write each session to Parquet once it is closed and past the watermark."""
    writer = (
        sessions(requests, gap, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with stateful_start(requests.sparkSession, partitions):
        return writer.start()


def _registry() -> StatefulProcessor:
    """The registry's state function. It is made here, so that it travels whole: Spark also loads it
    in a process of the driver that need not find this package."""

    class Registry(StatefulProcessor):
        """Per session: the epoch, and whether a resource is held in it.

        Of a batch's events, in order, only failures and the first assignment after each can
        matter; the rest is dropped as the rows come in, so a busy session holds no more than
        its failures.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("held", "epoch BIGINT, held BOOLEAN")

        def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:  # noqa: N802
            mattering = None
            for part in rows:
                part = part[["at", "held", "resource"]]
                mattering = self.mattering(part if mattering is None else pd.concat([mattering, part]))
            epoch, held = self.state.get() if self.state.exists() else (0, False)
            epochs = epoch + (mattering["held"] == 0).cumsum()
            offers = mattering[(mattering["held"] == 1) & ~((epochs == epoch) & held)]
            now = int(epochs.iloc[-1])
            self.state.update((now, bool(mattering["held"].iloc[-1] == 1) or (now == epoch and bool(held))))
            if len(offers):
                yield pd.DataFrame(
                    {
                        "session_id": [None if key[1] else key[0]] * len(offers),
                        "epoch": epochs[offers.index].to_list(),
                        "since": offers["at"].to_list(),
                        "resource": offers["resource"].to_list(),
                    }
                )

        @staticmethod
        def mattering(events: pd.DataFrame) -> pd.DataFrame:
            """Events in order (a failure first at equal times), without assignments that follow one."""
            events = events.sort_values(["at", "held", "resource"], kind="stable", ignore_index=True)
            return events[(events["held"] == 0) | (events["held"].shift() != 1)].reset_index(drop=True)

        def close(self) -> None:
            pass

    return Registry()


def stream_session_registry(
    assignments: DataFrame,
    failures: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    partitions: int | None = None,
):
    """Get-or-create over two streams: assignments (session_id, ts, resource) and failures
    (session_id, ts) as they happen.

    The first resource assigned stays until a failure drops it; the next one assigned then
    replaces it. Epoch and holder of a session are kept in the state store, so a batch costs
    its own rows; what is held is appended to `table` once. Inside a batch events count in the
    order of their times, a failure first; events of a later batch count as later. An assignment
    without a resource is none. `partitions` sets the number of state partitions for as long as the checkpoint lives.
    """
    resource = assignments.schema["resource"].dataType
    session = assignments.schema["session_id"].dataType.simpleString()
    # state is kept by values that are not null: one column for the session, one for its absence
    key = F.coalesce("session_id", F.lit(0).cast(session)).alias("session"), F.col("session_id").isNull().alias("none")
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    given = assignments.filter("resource IS NOT NULL")
    # no null in the column, which pandas would make floats of
    events = given.select(*key, at, F.lit(1).alias("held"), "resource").unionByName(
        failures.select(*key, at, F.lit(0).alias("held"), F.lit(0).cast(resource).alias("resource"))
    )
    found = events.groupBy("session", "none").transformWithStateInPandas(
        _registry(),
        f"session_id {session}, epoch BIGINT, since BIGINT, resource {resource.simpleString()}",
        "append",
        "none",
    )
    writer = (
        found.withColumn("since", F.timestamp_micros("since"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with stateful_start(assignments.sparkSession, partitions, KEYED_STATE):
        return writer.start()


def read_registry(spark: SparkSession, table: str) -> DataFrame:
    """session_id, epoch, since, resource: who held a session's resource, per epoch."""
    return spark.read.parquet(table)
