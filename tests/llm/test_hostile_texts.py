"""Texts made to be slow or large, at full limits and within bounds of time."""

import time
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import suffix_dedup, warc
from tallyline.llm.packing import packed_pieces

LONG = 600_000


def seconds(action):
    began = time.time()
    return action(), time.time() - began


@pytest.mark.parametrize("unit", [b"-", b"ab", b"a line of text\n", b"-" * 500 + b"x"])
def test_repetitive_texts_have_few_anchors(unit):
    body = np.frombuffer((unit * LONG)[:LONG], np.uint8)
    winnower = suffix_dedup._Winnower(200)
    for _, part in winnower.segments(body):
        owner, grams = winnower.owners(part)
        steady = winnower.steady(owner, grams)
        starts = np.arange(len(owner))
        assert (steady >= starts).all() and (steady < starts + 169).all() and (np.diff(steady) >= 0).all()
        assert (grams[steady] >> np.uint64(24) == grams[owner] >> np.uint64(24)).all()
        assert len(np.unique(steady)) <= len(part) // 60 + 2


def test_runs_are_removed_whole(make_docs):
    rng = np.random.default_rng(1)
    own = "".join(chr(97 + x) for x in rng.integers(0, 26, 3000))
    rows = [(1, "-" * LONG), (2, own + "ab" * 5000 + own[::-1]), (3, "x" + "-" * 199), (4, "x" + "-" * 200), (5, "ab" * 100), (6, own[:500] + "cd" * 110 + own[500:0:-1])]
    where, hit = Counter(), {}
    bodies = {d: t.encode() for d, t in rows}
    for body in bodies.values():
        where.update(sha256(body[s : s + 200]).digest() for s in range(min(len(body) - 199, 20_000)))
    for d, body in bodies.items():
        gone = np.zeros(len(body), bool)
        for s in range(min(len(body) - 199, 20_000)):
            if where[sha256(body[s : s + 200]).digest()] > 1:
                gone[s : s + 200] = True
        hit[d] = int(gone.sum())
    hit[1] = LONG
    got, took = seconds(lambda: suffix_dedup.removal_digest(make_docs(rows)).collect())
    assert {r.doc_id: r.n_removed for r in got} == hit and took < 120


@pytest.mark.parametrize("unit", ["<a ", "<p ", "<title ", "<title>", "<!--", "<script>", "< <a href=", "<a href='"])
def test_broken_pages_take_linear_time(spark, unit):
    page = unit * 100_000
    rows = spark.createDataFrame([(1, "u", page), (2, "u", page + ">"), (3, "u", page + "<title>x</title><a href='y'>")], "page_id int, url string, html string")
    found, took = seconds(lambda: warc.derivatives(warc.page_responses(rows)).collect())
    assert len(found) == 6 and took < 60


PAGES = [
    "<TITLE lang=x>a <b>c</b>\nd</TITLE><title>2</title>", "<title>no end", "<title", "x</title>", "<title>a</title", "<title>a</tit>b</title>",
    "<a href='1' href=\"2\">x</a><A\nclass=k HREF='3'", "<a href=4><a id='q' href=''>", "<a x <a href='5'>", "<ahref='6'>", "<a title='<' href='7'>", "a < b <c d", "<p>x</p y", "<br/><p/ ><hr", "",
]


def test_linear_patterns_find_what_the_plain_ones_find(spark):
    rows = spark.createDataFrame([(x,) for x in PAGES], "page string")
    got = rows.select("page", warc.title_of(F.col("page")).alias("title"), warc.links_of(F.col("page")).alias("links"), F.regexp_extract("page", r"(?is)<title[^>]*>(.*?)</title", 1).alias("plain_title"), F.regexp_extract_all("page", F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"'>]*)[\"']"), F.lit(1)).alias("plain_links")).collect()
    assert [(r.title, r.links) for r in got] == [(r.plain_title, r.plain_links) for r in got]


def test_a_million_spaces_are_packed(make_docs):
    got, took = seconds(lambda: packed_pieces(make_docs([(1, " " * 1_000_000), (2, "\n" * 1_000_000)])).collect())
    assert sum(r.length for r in got) == 1_000_001 + 500_001 and took < 60
