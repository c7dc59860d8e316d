"""A stored table with one row per key, in hash buckets, of which a merge rewrites only those it touches.

    data/version=<n>/bucket=<b>/   rows of a bucket, as version n left them
    manifest/<n>.json              for each bucket the version that holds its rows, and its first expiry

A version is there once its manifest is, and manifests appear whole. Applying a version that has
its manifest already changes nothing, so a repeated micro-batch is harmless; one that was cut
off before writes the same folders again. The last two versions stay readable, older data goes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.keyed import keyed_merge
from tallyline.sources.stored import names_in, read_json, remove, write_json

BUCKETS = 64
_BUCKET = "bucket"


class KeyTable:
    """Rows by key under `path`; `buckets` is fixed with the first version.

    A bucket is written by one task, so choose buckets by rows / rows that suit a task.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        schema: str,
        buckets: int = BUCKETS,
        expires: str | None = None,
    ):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), keys, schema
        self.buckets, self.expires = buckets, expires

    def versions(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in names_in(f"{self.path}/manifest") if x.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of the newest version, or of the newest one up to `version`."""
        found = [v for v in self.versions() if version is None or v <= version]
        content = read_json(f"{self.path}/manifest/{found[-1]}.json") if found else None
        return content or {"buckets": self.buckets, "of": {}, "until": {}}

    def bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(manifest["buckets"])).cast("int")

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows as of a version (the newest by default), of the given buckets (all by default)."""
        return self._rows(self.manifest(version), buckets)

    def _rows(self, manifest: dict, buckets: set[int] | None) -> DataFrame:
        folders = [
            f"{self.path}/data/version={v}/{_BUCKET}={b}"
            for b, v in manifest["of"].items()
            if buckets is None or int(b) in buckets
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def touched(self, rows: DataFrame, version: int | None = None) -> set[int]:
        """The buckets that hold the keys of some rows."""
        return {x[0] for x in rows.select(self.bucket(self.manifest(version))).distinct().collect()}

    def apply(
        self,
        version: int,
        changes: DataFrame,
        change: Callable[[DataFrame, DataFrame], DataFrame],
        now: datetime | None = None,
    ) -> None:
        """Make `version` (above all before) by `change(rows, changes)` of the touched buckets.

        With `now`, buckets that hold a row which has expired by then are touched as well, so that
        `change` can drop it.
        """
        if version in self.versions():
            return
        before = self.manifest(version - 1)
        touched = self.touched(changes, version - 1)
        if now is not None:
            at = self.spark.range(1).select(F.unix_micros(F.lit(now).cast("timestamp"))).first()[0]
            touched |= {int(b) for b, until in before["until"].items() if until <= at}
        rows = change(self._rows(before, touched), changes).withColumn(_BUCKET, self.bucket(before))
        folder = f"{self.path}/data/version={version}"
        if touched:
            rows.repartition(len(touched), _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)
        written = {x.removeprefix(f"{_BUCKET}=") for x in names_in(folder) if x.startswith(f"{_BUCKET}=")}
        of = {b: v for b, v in before["of"].items() if int(b) not in touched} | {b: version for b in written}
        until = {b: x for b, x in before["until"].items() if int(b) not in touched}
        if self.expires and written:
            paths = [f"{folder}/{_BUCKET}={b}" for b in written]
            rows = self.spark.read.schema(self.schema).option("basePath", folder).parquet(*paths)
            first = rows.groupBy(F.expr(f"regexp_extract(_metadata.file_path, '{_BUCKET}=([0-9]+)', 1)").alias("b"))
            found = first.agg(F.min(F.unix_micros(self.expires)).alias("x")).filter("x IS NOT NULL").collect()
            until |= {r["b"]: r["x"] for r in found}
        write_json(f"{self.path}/manifest/{version}.json", {"buckets": before["buckets"], "of": of, "until": until})
        self._forget(version, before["of"], of)

    def merge(self, version: int, changes: DataFrame, order_by: list[str], **columns) -> None:
        """`keyed_merge` of a log of column-level changes, written as `version`."""
        self.apply(version, changes, lambda rows, log: keyed_merge(rows, log, self.keys, order_by, **columns))

    def _forget(self, version: int, before: dict, now: dict) -> None:
        """Drop what neither this version nor the one before it reads."""
        for old in self.versions()[:-2]:
            for b, v in (read_json(f"{self.path}/manifest/{old}.json") or {"of": {}})["of"].items():
                if v not in (before.get(b), now.get(b)):
                    remove(f"{self.path}/data/version={v}/{_BUCKET}={b}")
            remove(f"{self.path}/manifest/{old}.json")
