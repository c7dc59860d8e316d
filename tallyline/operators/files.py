"""File request logs: normalising, replay status and the final file set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.defaults import if_empty
from tallyline.functions.prefix import cut, slice_window, sliced

# Status codes of a file request.
LISTED, WRITTEN, BAD_REQUEST, NOT_FOUND, FAILED = 200, 201, 400, 404, 500
FOLDER_NAMES = (".", "..")


def file_ops_normalize(requests: DataFrame) -> DataFrame:
    """Raw requests (seq, ts, method, path, body, is_base64) to file operations.

    The name is the second non-empty path segment or NULL. A body that cannot be decoded
    is NULL; a missing one is empty text. The size counts characters. `.` and `..` are no
    names of files: writing them fails, and nothing is found under them.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    plain = if_empty(F.col("body"), "")
    decoded = F.try_validate_utf8(lenient_base64(plain).cast("string"))
    content = F.when(F.coalesce("is_base64", F.lit(False)), decoded).otherwise(plain)
    writable = F.col("name").isNull() | ~F.col("name").isin(*FOLDER_NAMES)
    return (
        requests.withColumn("name", F.try_element_at(segments, F.lit(2)))
        .withColumn("content", F.when((F.col("method") == "PUT") & writable, content))
        .withColumn("size", F.length("content"))
        .select("seq", "ts", "method", "name", "content", "size")
    )


def lenient_base64(text: Column) -> Column:
    """Bytes of base64 text, or NULL.

    Characters outside the alphabet are skipped, and so is padding where a group of four
    cannot end; decoding stops at the padding that completes a group. An incomplete last
    group is an error.
    """
    known = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    a = "[A-Za-z0-9+/]"
    # whole groups are matched possessively, so long bodies need no deep recursion
    upto_end = f"^((?:=*+{a}=*+{a}=?{a}{a})*+(?:=*+{a}=*+{a}==|=*+{a}=*+{a}=?{a}=|=*+\\z))"
    matched = F.regexp_extract(known, upto_end, 1)
    data = F.replace(matched, F.lit("="), F.lit(""))
    padded = F.rpad(data, (F.ceil(F.length(data) / 4) * 4).cast("int"), F.lit("="))
    valid = known.rlike(upto_end)
    return F.when(valid, F.try_to_binary(padded, F.lit("base64")))


def _changes(ops: DataFrame) -> DataFrame:
    """The operations that change a file: deletes, and writes with a readable body."""
    wrote = (F.col("method") == "PUT") & F.col("content").isNotNull()
    return ops.filter(F.col("name").isNotNull() & (wrote | (F.col("method") == "DELETE")))


def file_log_compact(ops: DataFrame) -> DataFrame:
    """The files (name, content, seq) left after all operations: the last change of a name
    decides, and a deleted name is gone."""
    return final_changes(ops).filter(F.col("method") == "PUT").select("name", "content", "seq")


def final_changes(ops: DataFrame) -> DataFrame:
    """The last change of each name (name, method, content, seq); `seq` tells operations apart.

    The last one is found without the bodies, and only its own body moves.
    """
    changes = _changes(ops)
    last = changes.groupBy("name").agg(F.max("seq").alias("seq"))
    return changes.join(last, ["name", "seq"], "left_semi").select("name", "method", "content", "seq")


def file_op_status(ops: DataFrame, parts: int | None = None) -> DataFrame:
    """The status each operation gets when the log is replayed in `seq` order.

    Whether a name exists is decided by the last change before the operation. The file bodies
    take no part: they are not in the result.
    """
    named = F.col("name").isNotNull()
    readable = F.col("size").isNotNull()
    wrote = (F.col("method") == "PUT") & readable
    change = F.when(named & (wrote | (F.col("method") == "DELETE")), F.col("method"))
    rows = ops.drop("content").withColumn("_change", change)
    last = F.max_by("_change", F.when(F.col("_change").isNotNull(), F.col("seq")))
    cuts = cut(rows, ["name"], ["seq"], uses=("_change",), parts=parts, _last=(last, _last_known))
    before = slice_window(cuts).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    exists = F.coalesce(F.last("_change", ignorenulls=True).over(before), F.col("_last")) == "PUT"
    hit = F.when(exists, LISTED).otherwise(NOT_FOUND)
    status = (
        F.when((F.col("method") == "GET") & ~named, LISTED)
        .when((F.col("method").isin("GET", "DELETE")) & named, hit)
        .when((F.col("method") == "PUT") & named, F.when(readable, WRITTEN).otherwise(FAILED))
        .otherwise(BAD_REQUEST)
    )
    return (
        sliced(rows, cuts)
        .withColumn("status", status)
        .select(*[c for c in ops.columns if c != "content"], "status")
    )


def _last_known(column):
    return F.last(column, ignorenulls=True)
