"""The usage lake: JSON lines in, day-partitioned Parquet and an error area, pruned reads.

    area=usage/dt=<day>/commit=<name>/     records, by the writer's commit
    area=errors/dt=<day>/commit=<name>/    lines that are none
    _ingested/<name>.json                  batch commits that count, with their input files
    _compacted/<area>/<day>.json           commits of a day that one compacted commit replaces

Good and bad lines are parsed once and written by one job. Micro-batches (`s-` commits) overwrite
their own folders. Batch commits (`i-`) count once their file in `_ingested` is there, compacted
ones (`c-`) once the day's file in `_compacted` names them; both files appear whole, so a reader
sees each record once whatever runs beside it.
"""

from __future__ import annotations

import uuid
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.schemas import USAGE
from tallyline.sources.stored import names_in, read_json, remove, write_json

USAGE_AREA, ERROR_AREA = "usage", "errors"
_BAD = "_bad"
_FIELDS = [f.name for f in USAGE.fields]
_STORED = ", ".join(
    [f"{f.name} {'timestamp' if f.name == 'ts' else f.dataType.simpleString()}" for f in USAGE.fields]
    + ["bad_line STRING", "area STRING", "dt DATE"]
)


def parse_usage(lines: DataFrame) -> DataFrame:
    """Text lines (`value`) to the fixed nine columns of a usage record and `bad_line`.

    A missing field is NULL. A line that is not JSON, has a field of another type or a time
    that cannot be read has all nine NULL and is kept as `bad_line`.
    """
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in USAGE.fields)}, {_BAD} STRING"
    parsed = lines.select(
        "value", F.from_json("value", schema, {"columnNameOfCorruptRecord": _BAD}).alias("_r")
    )
    unread = F.col("_r.ts").isNotNull() & F.try_to_timestamp("_r.ts").isNull()
    is_bad = F.col("_r").isNull() | F.col(f"_r.{_BAD}").isNotNull() | unread
    fields = [F.when(~is_bad, F.col(f"_r.{name}")).alias(name) for name in _FIELDS]
    return parsed.select(*fields, F.when(is_bad, F.col("value")).alias("bad_line")).withColumn(
        "ts", F.try_to_timestamp("ts")
    )


def _day(dt_from: str) -> Column:
    """The partition day: of the record's time, or of its arrival (now).

    A record without a time goes by its arrival, so a read of any days can find it.
    """
    arrival = F.current_date()
    return {"event": F.coalesce(F.to_date("ts"), arrival), "arrival": arrival}[dt_from]


def in_areas(parsed: DataFrame, dt_from: str = "event") -> DataFrame:
    """Parsed lines (or bare usage records) with their area and day."""
    if "bad_line" not in parsed.columns:
        parsed = parsed.withColumn("bad_line", F.lit(None).cast("string"))
    bad = F.col("bad_line").isNotNull()
    return parsed.withColumn("area", F.when(bad, ERROR_AREA).otherwise(USAGE_AREA)).withColumn(
        "dt", _day(dt_from)
    )


def write_commit(parsed: DataFrame, path: str, commit: str, dt_from: str = "event") -> None:
    """Write parsed lines as the folders of one commit, over what an earlier try left there.

    Rebalancing by day gives files of the advisory partition size: small days are written
    by one task and a large day is split over several.
    """
    (
        in_areas(parsed, dt_from)
        .withColumn("commit", F.lit(commit))
        .hint("rebalance", "area", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("area", "dt", "commit")
        .parquet(path)
    )


def usage_ingest(lines: DataFrame, path: str, dt_from: str = "event", batch: str | None = None) -> None:
    """Append one batch of usage JSON lines to the lake, bad lines to its error area.

    With `batch`, a name of this input, a repeated job adds nothing; without it every call
    appends.
    """
    name = f"i-{sha256(batch.encode()).hexdigest()[:32] if batch else uuid.uuid4().hex}"
    _commit_batch(lines, path, dt_from, name, [])


def usage_ingest_files(spark: SparkSession, files: list[str], path: str, dt_from: str = "event") -> list[str]:
    """Append the lines of text files that the lake does not hold yet; returns these files.

    A file counts by its path, so the job may run as often as it likes, with the files of earlier
    runs among its input. One such job at a time.
    """
    held = {f for name in _ingested(path) for f in (read_json(f"{path}/_ingested/{name}.json") or {}).get("files", ())}
    fresh = sorted(set(files) - held)
    if fresh:
        name = sha256("\n".join(fresh).encode()).hexdigest()[:32]
        _commit_batch(spark.read.text(fresh), path, dt_from, f"i-{name}", fresh)
    return fresh


def _commit_batch(lines: DataFrame, path: str, dt_from: str, name: str, files: list[str]) -> None:
    if name not in _ingested(path):
        write_commit(parse_usage(lines), path, name, dt_from)
        write_json(f"{path}/_ingested/{name}.json", {"files": files})


def _ingested(path: str) -> set[str]:
    return {x.removesuffix(".json") for x in names_in(f"{path}/_ingested")}


def lake_days(path: str, area: str = USAGE_AREA, from_dt: str | None = None, to_dt: str | None = None) -> list[str]:
    """The days of an area, from..to inclusive, by one look at the names of the day folders."""
    days = [x.removeprefix("dt=") for x in names_in(f"{path}/area={area}") if x.startswith("dt=")]
    return [d for d in days if (not from_dt or d >= from_dt) and (not to_dt or d <= to_dt)]


def live_commits(path: str, area: str, day: str, ingested: set[str]) -> list[str]:
    """The commits whose files are a day's records now; only this day's folder is looked into."""
    compacted = read_json(f"{path}/_compacted/{area}/{day}.json") or {"by": None, "replaced": []}
    found = [x.removeprefix("commit=") for x in names_in(f"{path}/area={area}/dt={day}") if x.startswith("commit=")]
    counts = {"s": lambda c: True, "i": lambda c: c in ingested, "c": lambda c: c == compacted["by"]}
    return [c for c in found if counts[c[0]](c) and c not in compacted["replaced"]]


def _read(
    spark: SparkSession, path: str, area: str, from_dt: str | None = None, to_dt: str | None = None
) -> DataFrame:
    if "_spark_metadata" in names_in(path):  # of Spark's own sink, which logs the files that count
        return spark.read.schema(_STORED).parquet(path).filter(F.col("area") == area)
    ingested = _ingested(path)
    days = lake_days(path, area, from_dt, to_dt)
    return _read_commits(spark, path, area, {d: live_commits(path, area, d, ingested) for d in days})


def read_usage_lake(
    spark: SparkSession, path: str, from_dt: str | None = None, to_dt: str | None = None
) -> DataFrame:
    """Records of the days from..to (inclusive, open ends); folders of other days are not opened.

    New day folders are found at read time, so there is nothing to register.
    """
    lake = _read(spark, path.rstrip("/"), USAGE_AREA, from_dt, to_dt)
    if from_dt:
        lake = lake.filter(F.col("dt") >= F.lit(from_dt).cast("date"))
    if to_dt:
        lake = lake.filter(F.col("dt") <= F.lit(to_dt).cast("date"))
    return lake.select(*_FIELDS, "dt")


def read_usage_errors(spark: SparkSession, path: str) -> DataFrame:
    """The bad lines, as they came."""
    return _read(spark, path.rstrip("/"), ERROR_AREA).select(F.col("bad_line").alias("value"))


def compact_usage_lake(
    spark: SparkSession, path: str, commits: int = 8, from_dt: str | None = None, to_dt: str | None = None
) -> list[str]:
    """Replace the commits of days that have more than `commits` by one each; returns these days.

    All days are rewritten by one job, with files of the advisory size, and each is switched by
    one file. The replaced folders stay for readers that have begun; `forget_replaced` removes
    them later. One compaction at a time; writers may go on.
    """
    ingested, done = _ingested(path), []
    for area in (USAGE_AREA, ERROR_AREA):
        live = {d: live_commits(path, area, d, ingested) for d in lake_days(path, area, from_dt, to_dt)}
        live = {d: found for d, found in live.items() if len(found) > commits}
        if not live:
            continue
        name = f"c-{uuid.uuid4().hex}"
        rows = _read_commits(spark, path, area, live)
        (
            rows.withColumn("commit", F.lit(name))
            .hint("rebalance", "area", "dt")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("area", "dt", "commit")
            .parquet(path)
        )
        for day, found in live.items():
            before = read_json(f"{path}/_compacted/{area}/{day}.json") or {"replaced": []}
            write_json(f"{path}/_compacted/{area}/{day}.json", {"by": name, "replaced": sorted({*before["replaced"], *found})})
        done += list(live)
    return sorted(set(done))


def _read_commits(spark: SparkSession, path: str, area: str, live: dict[str, list[str]]) -> DataFrame:
    schema = f"{_STORED}, commit STRING"
    folders = [f"{path}/area={area}/dt={day}/commit={c}" for day, found in live.items() for c in found]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def forget_replaced(path: str) -> None:
    """Remove the folders that compactions have replaced, once no reader uses them any more."""
    for area in names_in(f"{path}/_compacted"):
        for file in names_in(f"{path}/_compacted/{area}"):
            day = file.removesuffix(".json")
            content = read_json(f"{path}/_compacted/{area}/{file}")
            for commit in content["replaced"]:
                remove(f"{path}/area={area}/dt={day}/commit={commit}")
            # a micro-batch that is repeated later must not come back
            kept = [c for c in content["replaced"] if c.startswith("s-")]
            write_json(f"{path}/_compacted/{area}/{file}", content | {"replaced": kept})
