import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("sig", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("score", T.StringType()),
        T.StructField("kind", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with clashing extra columns from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), "x", 1, "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
