"""Derived WARC records: metadata and plain-text conversions linked to their responses.

Every response gives two records that name it in WARC-Refers-To and keep its target, date and
digests. Derivation is made of DataFrame functions; only reading raw WARC bytes needs Python.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from functools import cache
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The references that the SQL twin knows and the characters they stand for.
REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&amp;": "&",
}
BLOCKS = "p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|blockquote|pre"
PAGE_DATE = "2024-01-01T00:00:00Z"


def record_id(*parts: Column) -> Column:
    """A name-based UUID of the parts, as a WARC record id."""
    digest = F.md5(F.concat_ws("\x1f", *parts).cast("binary"))
    cuts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def labelled_digest(body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(body, 256))


@cache
def _known_references() -> str:
    """Every named reference of HTML, and the numbers that do not stand for their own character.

    Frequent ones come first, as Spark looks through a map from its beginning.
    """
    first = {x[1:]: y for x, y in REFERENCES.items() if not x.startswith("&#")}
    known = first | {x: y for x, y in html5.items() if x.endswith(";") and x not in first}
    odd = [*range(0xA0), *range(0xFDD0, 0xFDF0), *(plane << 16 | x for plane in range(17) for x in (0xFFFE, 0xFFFF))]
    known |= {f"#{n}": html.unescape(f"&#{n};") for n in odd if html.unescape(f"&#{n};") != chr(n)}
    return "\x02".join(f"{x}\x01{y}" for x, y in (known | {"#160": " ", "NonBreakingSpace;": " "}).items())


def resolved(text: Column) -> Column:
    """The text with each named, decimal or hexadecimal reference resolved once, as HTML does.

    A no-break space becomes a space. Unknown names and references without their semicolon stay.
    """
    known = F.str_to_map(F.lit(_known_references()), F.lit("\x02"), F.lit("\x01"))
    pattern = r"^(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)"

    def code(ref: Column) -> Column:
        """The number of a numeric reference; 0x110000 for all that are beyond Unicode."""
        hexadecimal = F.lower(F.substring(ref, 2, 1)) == "x"
        digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
        number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int")
        return F.when(digits == "", 0).when(F.length(digits) > 7, 0x110000).otherwise(number)

    def numbered(n: Column) -> Column:
        digits = F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n), 8, "0"))  # with a byte order mark
        beyond = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        own = F.when(beyond, "\ufffd").otherwise(F.decode(F.unhex(digits), "UTF-32"))
        return F.coalesce(F.try_element_at(known, F.concat(F.lit("#"), n.cast("string"))), own)

    def found(part: Column, place: Column) -> Column:
        ref = F.when(place > 0, F.regexp_extract(part, pattern, 1)).otherwise("")
        return F.struct(part.alias("part"), ref.alias("ref"))

    def joined(x: Column, place: Column) -> Column:
        named = F.try_element_at(known, x["ref"])
        number = F.element_at(F.transform(F.array(code(x["ref"])), numbered), 1)
        character = F.when(x["ref"].startswith("#"), number).otherwise(named)
        rest = F.substr(x["part"], F.length(x["ref"]) + 1)
        whole = F.concat(F.lit("&"), x["part"])
        return F.when(place == 0, x["part"]).when(x["ref"] == "", whole).otherwise(F.coalesce(F.concat(character, rest), whole))

    return F.array_join(F.transform(F.transform(F.split(text, "&", -1), found), joined), "")


def plain_text(markup: Column) -> Column:
    """Visible text: comments, scripts, styles and tags go, block tags break lines, references
    are resolved and white space is collapsed. An unclosed comment or script hides the rest."""
    out = F.regexp_replace(markup, r"(?is)<!--.*?(-->|\z)", " ")
    out = F.regexp_replace(out, r"(?is)<(script|style|noscript|template)\b.*?(</\1\s*>|\z)", " ")
    out = resolved(F.element_at(F.transform(F.array(out), _without_tags), 1))
    out = F.regexp_replace(out, r"[ \t\r\f]{2,}|[\t\r\f]", " ")
    return F.btrim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def _closed(markup: Column) -> tuple[Column, Column]:
    """The markup up to its last `>`, and the rest.

    Tags end in the first part, so no search for the end of a tag runs through the rest again and
    again, however many `<` are in it.
    """
    rest = F.substring_index(markup, ">", -1)
    return F.left(markup, F.length(markup) - F.length(rest)), rest


def _without_tags(markup: Column) -> Column:
    closed, rest = _closed(markup)
    closed = F.regexp_replace(closed, rf"(?i)</?({BLOCKS})(\s[^>]*)?/?>", "\n")
    return F.concat(F.regexp_replace(closed, r"<[/!?A-Za-z][^>]*>", ""), rest)


def title_of(markup: Column) -> Column:
    """What stands between the first title tag and the next end of one, or an empty text."""
    closed, rest = _closed(markup)
    behind = F.concat(F.get(F.split(closed, r"(?i)<title[^>]*>", 2), F.lit(1)), rest)
    return F.coalesce(F.regexp_extract(behind, r"(?is)\A(.*?)</title", 1), F.lit(""))


def links_of(markup: Column) -> Column:
    """The last quoted `href` of each anchor tag that has one."""
    tags = F.regexp_extract_all(markup, F.lit(r"(?i)<a\s[^>]*"), F.lit(0))
    href = F.lit(r"(?is)\A.*href=[\"']([^\"'>]*)[\"']")
    return F.flatten(F.transform(tags, lambda x: F.regexp_extract_all(x, href, F.lit(1))))


def header(text: Column, name: str) -> Column:
    """The value of an HTTP header, or null."""
    found = F.regexp_extract(text, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def page_responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of stored pages: record_id, target_uri, date, http_headers, payload."""
    size = F.octet_length(F.coalesce(F.col(html), F.lit("")))
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    return pages.select(
        record_id(F.lit("response"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit(""))).alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(PAGE_DATE).alias("date"),
        F.concat(F.lit("\r\n".join(lines) + "\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n")).alias("http_headers"),
        F.col(html).alias("payload"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response: `metadata` (application/warc-fields) and `conversion` (text/plain).

    Columns: kind, record_id, refers_to, target_uri, date, content_type, content_length,
    block_digest, source_payload_digest, source_block_digest, source_status,
    source_content_type, block, record. `record` is the whole WARC/1.1 record as text.

    A null payload counts as empty and gives an empty conversion; a null or malformed HTTP
    header gives null source fields, which the records leave out. A null target is left out
    too. Repeated responses give repeated records with equal ids. An empty table gives an empty
    result; other columns are not used.
    """
    payload, headers = F.coalesce("payload", F.lit("")), F.coalesce("http_headers", F.lit(""))
    status = F.regexp_extract(headers, r"^HTTP/[0-9.]+ ([0-9]+)", 1)
    source = responses.select(
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        labelled_digest(payload).alias("source_payload_digest"),
        labelled_digest(F.concat(headers, payload)).alias("source_block_digest"),
        F.when(status != "", status).alias("source_status"),
        header(headers, "Content-Type").alias("source_content_type"),
        headers.alias("headers"),
        plain_text(payload).alias("text"),
        plain_text(title_of(payload)).alias("title"),
        links_of(payload).alias("links"),
    )
    lines = F.concat(
        _field("title", F.regexp_replace("title", r"\s+", " ")),
        _field("http-status", F.col("source_status")),
        _field("payload-digest", F.col("source_payload_digest")),
        F.array_join(
            F.transform(
                F.filter(F.split(F.col("headers"), "\r\n"), lambda x: x.contains(":")),
                lambda x: F.concat(F.lit("source-header: "), x, F.lit("\r\n")),
            ),
            "",
        ),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), resolved(x), F.lit("\r\n"))), ""),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("content_type"), lines.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = source.withColumn("made", F.explode(both)).select("*", "made.*")
    rows = rows.withColumns(
        {
            "record_id": record_id(F.col("kind"), F.coalesce("refers_to", F.lit(""))),
            "content_length": F.octet_length("block").cast("bigint"),
            "block_digest": labelled_digest(F.col("block")),
        }
    )
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.col("kind")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Block-Digest", F.col("block_digest")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit("\r\n\r\n"),
    )
    return rows.select(
        "kind", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest",
        "source_payload_digest", "source_block_digest", "source_status", "source_content_type", "block",
        record.alias("record"),
    )


def _field(name: str, value: Column) -> Column:
    """`name: value` with its line end, or nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(records: DataFrame, folder: str) -> None:
    """Whole WARC records, one after the other, in gzip files of Spark's text writer."""
    body = F.expr("substring(record, 1, length(record) - 4)").alias("value")  # the writer adds the end
    records.select(body).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)


def parse_responses(files: DataFrame, content: str = "content") -> DataFrame:
    """Response records from uncompressed WARC files read with Spark's `binaryFile` source.

    Other record types are skipped. A file is one value of its row, as the source gives it, so
    it should be of ordinary WARC size; a truncated last record is left out.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0).to_pylist():
                rows = list(_records(body or b""))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], ["record_id", "target_uri", "date", "http_headers", "payload"]
                )

    return files.select(content).mapInArrow(
        parse, "record_id string, target_uri string, date string, http_headers string, payload string"
    )


def _records(body: bytes) -> Iterator[tuple]:
    at = 0
    while (at := body.find(b"WARC/1.", at)) >= 0 and (end := body.find(b"\r\n\r\n", at)) >= 0:
        fields = {}
        for line in body[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size = fields.get("content-length", "")
        if not size.isdigit():
            at = end
            continue
        block = body[end + 4 : end + 4 + int(size)]
        at = end + 4 + int(size)
        if len(block) == int(size) and fields.get("warc-type") == "response":
            head, gap, payload = block.partition(b"\r\n\r\n")
            yield (
                fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
                (head + gap).decode("utf-8", "replace"), payload.decode("utf-8", "replace"),
            )
