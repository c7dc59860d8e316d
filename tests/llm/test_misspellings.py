"""Misspelled terms of the toxicity lexicon: words and stems, in any letter."""

import numpy as np
from test_texts import distance

from tallyline.llm import toxicity


def test_one_edit_in_any_letter_of_words_and_stems():
    rng = np.random.default_rng(8)
    words, stems = ["loser", "clown", "scum", "abc"], ["abwurs", "scrow"]
    lexicon = toxicity.Lexicon(words, stems, any_letter=True)
    met = set()
    for _ in range(6000):
        token = list(str(rng.choice([*words, *stems])) + "".join(rng.choice(list("aow"), rng.integers(0, 3))))
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(len(token))
            token[at : at + rng.integers(0, 2)] = rng.choice(list("abclorsuw"), rng.integers(0, 2)).tolist()
        token = "".join(token)
        near = any(len(w) >= 4 and distance(token, w) <= 1 for w in words) or any(
            distance(token[:n], s) <= 1 for s in stems for n in range(len(token) + 1)
        )
        want = toxicity.FUZZY if near else toxicity.NONE
        want = toxicity.STEM if token.startswith(tuple(stems)) else toxicity.EXACT if token in words else want
        met.add(want)
        assert lexicon.kind(token) == want, token
    assert len(met) == 4


def test_a_known_word_is_no_misspelling():
    lexicon = toxicity.Lexicon(["moron"], ["stemm"], any_letter=True, known=["boron", "moron", "stem"])
    kinds = {x: lexicon.kind(x) for x in ("boron", "b0ron!", "coron", "moron", "stem", "stempel", "xtemmen")}
    none, fuzzy = toxicity.NONE, toxicity.FUZZY
    assert kinds == {"boron": none, "b0ron!": none, "coron": fuzzy, "moron": toxicity.EXACT, "stem": none, "stempel": fuzzy, "xtemmen": fuzzy}


def test_misspelled_terms_are_learned_and_found(spark, make_docs):
    """A word, a stem, a three-letter term; `boron` is a word of clean documents."""
    clean = [(i, f"boron word{'abcdefgh'[i % 8]} talk about water and stone") for i in range(1000, 1400)]
    toxic = [(i, f"talk about {x} and water") for i, x in enumerate(["moron", "gruntig", "grunten", "oaf"] * 30)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in toxic + clean], "doc_id long, toxic int")
    asked = ["noron", "mron", "grynten", "qrunteln", "oaf", "boron", "stone", "water"]
    model = toxicity.learn(make_docs(toxic + clean), labels)
    assert "boron" in model[2]
    rows = toxicity.toxicity_scores(make_docs([(i, f"talk about {x} and water") for i, x in enumerate(asked)]), model)
    got = {asked[r.doc_id]: r.predicted for r in rows.collect()}
    assert got == {x: int(x not in ("boron", "stone", "water")) for x in asked}
