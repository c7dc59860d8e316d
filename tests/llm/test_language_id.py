import numpy as np

from tallyline.llm import language_id
from tallyline.llm.language_id import fold_model, learn_and_predict, with_languages


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = learn_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 20
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97


def test_mixture_shares(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = {r.lang: r.text for r in docs.filter("length(text) > 3000").select("lang", "text").collect()}
    a, b = " ".join(one["en"].split()[:300]), " ".join(one["de"].split()[:100])
    mixed = spark.createDataFrame([(1, f"{a} {b}"), (2, a)], "doc_id long, text string")
    got = {r.row.doc_id: {x.lang: x.share for x in r.languages} for r in with_languages(mixed, fold_model(docs)).collect()}
    assert abs(got[1]["en"] - 0.75) < 0.1 and abs(got[1]["de"] - 0.25) < 0.1
    assert set(got[2]) == {"en"}


def test_selection_matches_plain_em():
    """The fitted proportions maximise the likelihood that plain rounds climb."""
    rng = np.random.default_rng(2)
    likelihood = np.log(rng.random((200, 3))).astype(np.float32)
    likelihood[:, 2] -= 9
    share = language_id.mixtures(likelihood, np.repeat([0, 3], 100), 4)
    assert (share[[1, 2]] == 0).all() and np.allclose(share[[0, 3]].sum(1), 1)
    for doc, rows in ((0, likelihood[:100]), (3, likelihood[100:])):
        odds, own = np.exp(rows.astype(float)), share[doc]
        assert own[2] == 0
        best = max(
            (np.log(odds @ np.array([p, 1 - p, 0])).sum(), p) for p in np.linspace(0, 1, 1001)
        )
        assert np.log(odds @ own).sum() >= best[0] - 0.5 * np.log(101) - 1e-6


def test_edge_texts(make_docs):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "the cat", "en"), (5, "le chat", "fr"), (5, "le chat", "fr"), (None, "le", "fr"), (7, "日本語")]
    got = with_languages(make_docs(rows), fold_model(make_docs(rows * 3))).collect()
    found = {r.row.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all((found[k].lang_pred, found[k].score, found[k].languages) == ("und", 0.0, []) for k in (1, 2, 3))
    assert found[7].lang_pred in ("en", "fr") and 0 <= found[7].score <= 1
    assert found[4].row.sig == "x" and found[4].row.score == "y"


def test_nothing_learned(make_docs):
    docs = make_docs([(1, "some words"), (2, None)])
    assert {(r.lang_pred, r.score) for r in learn_and_predict(docs).collect()} == {("und", 0.0)}
    assert learn_and_predict(make_docs([])).count() == 0


def test_long_document_in_chunks(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = fold_model(docs)
    tables = language_id._tables(model)
    text = docs.orderBy("n_chars", ascending=False).first().text.encode()
    body = np.frombuffer(text, np.uint8)
    whole = language_id._shares(body, np.array([0, len(body)]), tables)
    monkeypatch.setattr(language_id, "CHUNK", 500)
    assert np.allclose(whole, language_id._shares(body, np.array([0, len(body)]), tables), atol=1e-6)
