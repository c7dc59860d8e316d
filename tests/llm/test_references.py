"""Character references against Python's own list and `html.unescape`."""

import html
from html.entities import html5

from pyspark.sql import functions as F

from tallyline.llm import warc

NUMBERS = [*range(0x180), 0x2019, 0x20AC, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFEFF, 0xFFFE, 0xFFFF, 0x1F642, 0x10FFFE, 0x10FFFF, 0x110000, 1 << 31, 1 << 70]


def test_every_reference(spark):
    texts = [f"a&{x}b&{x}" for x in html5 if x.endswith(";")]
    texts += [f"a&#{form};b" for n in NUMBERS for form in (n, f"000{n}", f"x{n:x}", f"X00{n:X}")]
    texts += ["&amp;lt; &amp;amp;eacute; &amp;#39;", "&&lt;&", "&unknown; &#; &#x; &; & x", "é&eacute;🙂&#x1F642;", "", "plain"]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", warc.resolved(F.col("t")).alias("got")).collect()
    for r in rows:
        assert r.got == html.unescape(r.t).replace("\xa0", " "), r.t


def test_references_without_semicolon_stay(spark):
    texts = ["x &amp y", "&copy=1&lang=2", "&#39 &#x27", None]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", warc.resolved(F.col("t")).alias("got")).collect()
    assert all(r.got == r.t for r in rows)


def test_records_resolve_references(spark):
    page = "<title>Caf&eacute; &#8217;s</title><p>&uuml;&euro;&rsquo;&#x27;&#8217;&amp;eacute;</p><a href='/?a&#38;b&eacute;&amp;lt;'>x</a>"
    responses = warc.page_responses(spark.createDataFrame([(1, "http://a/", page)], "page_id int, url string, html string"))
    blocks = {r.kind: r.block for r in warc.derivatives(responses).collect()}
    assert blocks["conversion"] == "Café ’s\nü€’'’&eacute;\nx"
    assert "title: Café ’s\r\n" in blocks["metadata"] and "outlink: /?a&bé&lt;\r\n" in blocks["metadata"]
