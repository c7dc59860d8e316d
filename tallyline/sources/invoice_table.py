"""Stored invoices, laid out for look-ups by customer and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.schemas import INVOICES


def write_invoices(invoices: DataFrame, path: str, mode: str = "error") -> None:
    """Write invoices clustered by customer and date.

    Files hold ranges of (customer, date) and are sorted, so the file statistics let a
    customer or date filter skip almost all of them; a large customer spans several files.
    """
    by = ["customer_name", "invoice_date"]
    invoices.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode).parquet(path)


def read_invoices(spark: SparkSession, path: str, schema=INVOICES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
