"""JSON-lines sink with money, at any depth, as plain JSON numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.invoices import export_amount


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON text per row (`value`); decimals print as integers where they are whole,
    and else in plain notation, inside arrays, maps and structs as well."""
    fields = [_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def _has_decimal(kind: T.DataType) -> bool:
    parts = {
        T.StructType: lambda: [f.dataType for f in kind.fields],
        T.ArrayType: lambda: [kind.elementType],
        T.MapType: lambda: [kind.valueType],
    }
    return isinstance(kind, T.DecimalType) or any(map(_has_decimal, parts.get(type(kind), list)()))


def _plain(value: Column, kind: T.DataType) -> Column:
    if not _has_decimal(kind):
        return value
    if isinstance(kind, T.DecimalType):
        return export_amount(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _plain(x, kind.valueType))
    inner = F.struct(*[_plain(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
    return F.when(value.isNotNull(), inner)


def export_json(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Write rows as JSON lines."""
    json_lines(rows).write.mode(mode).text(path)
