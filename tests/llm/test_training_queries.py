"""Every registered query: against its SQL, or at least its columns and row count."""

import compare
import pytest

from tallyline.llm import queries


@pytest.fixture(scope="module")
def duck(small):
    with compare.connect(small) as con:
        yield con


@pytest.mark.parametrize("name", list(queries.SQL))
def test_matches_sql(spark, duck, small, name):
    assert compare.differences(queries.QUERIES[name](spark, small), duck, queries.SQL[name]) is None


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op2_language_mixture", ["doc_id", "held_out", "lang_pred", "score", "languages"]),
        ("op7_piece_counts", ["doc_id", "n_words", "n_tokens"]),
        ("op10_levenshtein_lexicon", ["doc_id", "held_out", "score", "predicted"]),
        ("op12_token_files", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    ],
)
def test_one_row_per_document(spark, duck, small, name, columns):
    rows = queries.QUERIES[name](spark, small)
    assert rows.columns == columns
    assert sorted(r.doc_id for r in rows.collect()) == [x for (x,) in duck.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_registered(spark):
    import __spark_entry__ as entry

    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())
