"""The pipeline's language stage where no language can be learned."""

import corpus_pipeline


def test_documents_stay_without_a_model(spark, make_docs, small):
    rows = [(1, "some words", None), (2, "été", None), (3, "12 + 3", None), (4, None, None), (5, "", None)]
    got = corpus_pipeline.language_id(spark, make_docs(rows), small)
    assert sorted((r.doc_id, r.text, r.lang) for r in got.collect()) == [(1, "some words", None), (2, "été", None)]


def test_found_languages_deal_the_windows(spark, make_docs, small):
    """A window holds one language, and a document without one goes by what the first stage found."""
    own = {"en": "the house and the garden of the old man", "fr": "la maison et le jardin du vieil homme"}
    rows = [(k, f"{own[lang]} {k}", lang) for k, lang in enumerate(["en", "fr"] * 60)]
    rows += [(900, own["en"], None), (901, own["fr"], None)]
    found = corpus_pipeline.language_id(spark, make_docs(rows), small)
    pieces = corpus_pipeline.packing(spark, found.coalesce(1), small).collect()
    want = {r.doc_id: r.lang for r in found.collect()}
    assert want[900] == "en" and want[901] == "fr"
    assert all(r.lang == want[r.doc_id] for r in pieces) and {r.doc_id for r in pieces} == set(want)
    windows = {}
    for r in pieces:
        windows.setdefault(r.sequence_id, set()).add(r.lang)
    assert all(len(x) == 1 for x in windows.values()) and len(windows) > 1
