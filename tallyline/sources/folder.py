"""Folders of whole text files: write, list and read by name.

Spark's own file readers skip empty files, which are files like any other here, so listing
and reading go to the folder's file system from inside the tasks.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.files import FOLDER_NAMES, final_changes

_LIST_BATCH = 10_000
UNFINISHED = ".unfinished"
# Hadoop's schemes and what the same stores are called here.
SCHEMES = {"s3a": "s3://", "s3n": "s3://", "dbfs": "file:///dbfs/", "wasbs": "abfss://", "wasb": "abfs://"}


def put_files(files: DataFrame, path: str) -> None:
    """Write each row (name, content) as one file in the folder, replacing older ones.

    Rows stream through the tasks, so one file at a time is in memory. Each file is written
    in a folder below and then moved over the old one, so a repeated task leaves the same
    files and the listing never sees a half-written one. Rows whose name is none of a file
    (`.`, `..`, or with a slash) are skipped.
    """

    def write(rows: Iterator[Row]) -> None:
        target, root = file_system(path)
        target.create_dir(f"{root}/{UNFINISHED}", recursive=True)
        for row in rows:
            if not _is_file_name(row["name"]):
                continue
            part = f"{root}/{UNFINISHED}/{uuid.uuid4().hex}"
            with target.open_output_stream(part) as out:
                out.write(row["content"].encode())
            target.move(part, f"{root}/{row['name']}")

    files.select("name", "content").foreachPartition(write)


def remove_files(names: DataFrame, path: str) -> None:
    """Remove the named files (rows with `name`) from the folder; absent ones do not matter."""

    def remove(rows: Iterator[Row]) -> None:
        target, root = file_system(path)
        for row in rows:
            file = f"{root}/{row['name']}"
            if _is_file_name(row["name"]) and target.get_file_info(file).type == fs.FileType.File:
                target.delete_file(file)

    names.select("name").foreachPartition(remove)


def apply_log(ops: DataFrame, path: str) -> None:
    """Bring the folder to the state after all operations of a file log.

    Only the last change of a name counts, so writes and deletes touch different files and
    a repeated run leaves the same folder.
    """
    last = final_changes(ops)
    put_files(last.filter("method = 'PUT'"), path)
    remove_files(last.filter("method = 'DELETE'"), path)


def _is_file_name(name: str | None) -> bool:
    return bool(name) and name not in FOLDER_NAMES and "/" not in name


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a folder as Spark names it.

    Schemes that only differ by the client that reads them are translated.
    """
    scheme, colon, rest = path.partition(":")
    if colon and scheme in SCHEMES:
        path = SCHEMES[scheme] + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Names and byte sizes of the regular files directly in the folders, by name.

    Each folder is listed by one task of its own, which yields as it goes where the file
    system is mounted, and no content is read.
    """

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files = ({"folder": path, "name": name, "bytes": size} for name, size in _regular_files(path))
                while found := list(islice(files, _LIST_BATCH)):
                    yield pa.RecordBatch.from_pylist(found, schema=listed)

    listed = pa.schema([("folder", pa.string()), ("name", pa.string()), ("bytes", pa.int64())])
    folders = spark.createDataFrame([(p,) for p in paths], "path STRING").repartition(len(paths))
    return folders.mapInArrow(names, "folder STRING, name STRING, bytes BIGINT").orderBy("name", "folder")


def _regular_files(path: str) -> Iterator[tuple[str, int]]:
    target, root = file_system(path)
    if isinstance(target, fs.LocalFileSystem):
        with os.scandir(root) as entries:
            for entry in entries:
                if entry.is_file():
                    yield entry.name, entry.stat().st_size
    else:
        for info in target.get_file_info(fs.FileSelector(root)):
            if info.type == fs.FileType.File:
                yield info.base_name, info.size


def read_files(path: str, names: DataFrame) -> DataFrame:
    """Each requested name (rows with `name`) with the whole file as `content`, and `found`.

    Only the requested files are opened, each once however often it is asked for. A file
    that is not valid UTF-8 is found but has no content.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = file_system(path)
        for batch in batches:
            for name in filter(_is_file_name, batch.column("name").to_pylist()):
                file = f"{root}/{name}"
                if target.get_file_info(file).type == fs.FileType.File:
                    with target.open_input_stream(file) as source:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name]), pa.array([source.read()], pa.binary())], ["name", "bytes"]
                        )

    files = (
        names.filter("name IS NOT NULL")
        .select("name")
        .distinct()
        .mapInArrow(read, "name STRING, bytes BINARY")
        .select("name", F.try_validate_utf8(F.col("bytes").cast("string")).alias("content"), F.lit(True).alias("_hit"))
    )
    return (
        names.join(files, "name", "left").withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")
    )
