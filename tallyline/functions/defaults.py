"""The two default rules of the service back-ends, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def if_missing(value: Column, default) -> Column:
    """The default where the value is absent; an empty string is a value and stays."""
    return F.coalesce(value, _column(default))


def if_empty(value: Column, default) -> Column:
    """The default where the value is absent or an empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), _column(default))
