"""DuckDB SQL that answers the same questions as the queries, by the plainest route."""

from tallyline.llm import warc

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS grams
  FROM words),
postings AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (
  SELECT l.doc_id AS a, r.doc_id AS b
  FROM postings l JOIN postings r ON l.gram = r.gram AND l.doc_id <> r.doc_id
  GROUP BY l.doc_id, r.doc_id, l.n, r.n
  HAVING 100 * count(*) >= 90 * (l.n + r.n - count(*))),
reach(doc_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce(min(reach.other), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach ON reach.doc_id = s.doc_id
GROUP BY s.doc_id, s.grams
"""

# Bytes are compared as hexadecimal digits, two for each byte.
SUFFIX_ARRAY = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT r, unnest(range(len(h) // 2 - 199)) AS s, h FROM texts WHERE len(h) >= 400),
windows AS (SELECT r, s, md5(substr(h, 2 * s + 1, 400)) AS m FROM starts),
often AS (SELECT m FROM windows GROUP BY m HAVING count(*) > 1),
hits AS (SELECT r, s FROM windows JOIN often USING (m)),
marked AS (
  SELECT r, s, CASE WHEN s <= max(s) OVER (PARTITION BY r ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200
                    THEN 0 ELSE 1 END AS fresh
  FROM hits),
numbered AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS span FROM marked),
spans AS (SELECT r, span, min(s) AS lo, max(s) + 200 AS hi FROM numbered GROUP BY r, span),
edges AS (
  SELECT r, span, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY r ORDER BY lo) AS before,
         lead(lo) OVER (PARTITION BY r ORDER BY lo) AS next
  FROM spans),
kept AS (
  SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed,
         string_agg(substr(h, 2 * before + 1, 2 * (lo - before))
                    || CASE WHEN next IS NULL THEN substr(h, 2 * hi + 1) ELSE '' END, '' ORDER BY lo) AS left_over
  FROM edges JOIN texts USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

_HIT_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
DECONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_HIT_WORDS}') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_HIT_WORDS}') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
placed AS (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM sized),
windows AS (
  SELECT DISTINCT item, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS pattern FROM placed),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM docs, sizes WHERE len(w) >= size),
matches AS (
  SELECT r, s, starts.size, item
  FROM starts JOIN windows
    ON windows.size = starts.size AND pattern = array_to_string(list_slice(w, s, s + starts.size - 1), ' ')),
hit AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS word FROM matches) GROUP BY r),
listed AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM matches) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT l.r AS a, r.r AS b, l.vec_id AS a_id, r.vec_id AS b_id
  FROM vectors l JOIN vectors r ON l.label = r.label AND l.r <> r.r AND len(l.v) = len(r.v)
  WHERE list_cosine_similarity(l.v, r.v) >= 0.93),
reach(a, b, b_id) AS (
  SELECT a, b, b_id FROM links
  UNION
  SELECT reach.a, links.b, links.b_id FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a, min(b_id) AS least FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM vectors LEFT JOIN least_id ON least_id.a = r LEFT JOIN counts ON counts.a = r
"""

CHATS = """
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM rows GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, len(turns) AS total, n, list_slice(turns, 1, n) AS part
  FROM (SELECT conv_id, turns, unnest(range(1, len(turns) + 1)) AS n FROM convs)),
maximal AS (
  SELECT c.conv_id, c.turns FROM convs c
  WHERE NOT EXISTS (
    SELECT 1 FROM prefixes p
    WHERE p.part = c.turns AND (p.total > len(c.turns) OR p.conv_id < c.conv_id)))
SELECT conv_id, CAST(0 AS BIGINT) AS page, CAST(len(turns) AS BIGINT) AS n_turns,
       array_to_string(list_transform(turns, lambda t: '<|im_start|>' || coalesce(t.role, 'unknown') || chr(10)
         || coalesce(t.text, '') || '<|im_end|>' || chr(10)), '') AS chat
FROM maximal
"""


def _plain_sql(html: str) -> str:
    out = f"regexp_replace({html}, '(?is)<!--.*?(-->|\\z)', ' ', 'g')"
    for tag in ("script", "style", "noscript", "template"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b.*?(</{tag}\\s*>|\\z)', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)</?({warc.BLOCKS})(\\s[^>]*)?/?>', chr(10), 'g')"
    out = f"regexp_replace({out}, '<[/!?A-Za-z][^>]*>', '', 'g')"
    for name, character in warc.REFERENCES.items():
        written = "chr(39)" if character == "'" else f"'{character}'"
        out = f"replace({out}, '{name}', {written})"
    out = f"regexp_replace({out}, '[ \\t\\r\\f]+', ' ', 'g')"
    out = f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({out}, '\\A[ \\n]+|[ \\n]+\\z', '', 'g')"


def _uuid_sql(text: str) -> str:
    cuts = " || '-' || ".join(f"substr(md5({text}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cuts} || '>'"


_CRLF = "chr(13) || chr(10)"
WARC_DERIVATIVES = f"""
WITH pages_text AS (
  SELECT coalesce(html, '') AS payload, url AS target_uri,
         {_uuid_sql("'response' || chr(31) || coalesce(CAST(page_id AS VARCHAR), '') || chr(31) || coalesce(url, '')")} AS refers_to,
         'Content-Length: ' || strlen(coalesce(html, '')) AS size_line
  FROM pages),
headed AS (
  SELECT *, 'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF}
            || size_line || {_CRLF} || {_CRLF} AS headers
  FROM pages_text),
source AS (
  SELECT *, 'sha256:' || sha256(payload) AS source_payload_digest, 'sha256:' || sha256(headers || payload) AS source_block_digest,
         {_plain_sql("payload")} AS text,
         regexp_replace({_plain_sql("regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title', 1)")}, '\\s+', ' ', 'g') AS title,
         regexp_extract_all(payload, '(?i)<a\\s[^>]*href=["'']([^"''>]*)["'']', 1) AS links
  FROM headed),
made AS (
  SELECT *, 'metadata' AS kind, 'application/warc-fields' AS content_type,
         'title: ' || title || {_CRLF} || 'http-status: 200' || {_CRLF} || 'payload-digest: ' || source_payload_digest || {_CRLF}
         || 'source-header: Content-Type: text/html; charset=utf-8' || {_CRLF} || 'source-header: ' || size_line || {_CRLF}
         || array_to_string(list_transform(links, lambda x: 'outlink: ' || replace(x, '&amp;', '&') || {_CRLF}), '') AS block
  FROM source
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', text FROM source),
named AS (
  SELECT *, {_uuid_sql("kind || chr(31) || refers_to")} AS record_id, CAST(strlen(block) AS BIGINT) AS content_length,
         'sha256:' || sha256(block) AS block_digest
  FROM made)
SELECT kind, record_id, refers_to, target_uri, '{warc.PAGE_DATE}' AS date, content_type, content_length, block_digest,
       source_payload_digest, source_block_digest, '200' AS source_status, 'text/html; charset=utf-8' AS source_content_type, block,
       'WARC/1.1' || {_CRLF} || 'WARC-Type: ' || kind || {_CRLF} || 'WARC-Record-ID: ' || record_id || {_CRLF}
       || 'WARC-Refers-To: ' || refers_to || {_CRLF} || coalesce('WARC-Target-URI: ' || target_uri || {_CRLF}, '')
       || 'WARC-Date: {warc.PAGE_DATE}' || {_CRLF} || 'WARC-Block-Digest: ' || block_digest || {_CRLF}
       || 'Content-Type: ' || content_type || {_CRLF} || 'Content-Length: ' || content_length || {_CRLF} || {_CRLF}
       || block || {_CRLF} || {_CRLF} AS record
FROM named
"""

# crc32 bit by bit, over the ASCII digits of doc_id
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
    lambda x, round: xor(x >> 1, 3988292384 * (x & 1)))))"""
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(n_chars: str) -> str:
    named = ["n_chars_used" if x == "n_chars" else x for x in _FIELDS]
    texts = [f"CAST({n_chars if x == 'n_chars_used' else x} AS VARCHAR)" for x in named]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in texts) + ")"


MERKLE_MANIFEST = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf_sql("n_chars")} AS leaf,
         {_leaf_sql(f"(CASE WHEN {_CRC} % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs),
nodes(tree, level, n, h) AS (
  SELECT tree, 0, i, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, n // 2, sha256(string_agg(h, '' ORDER BY n))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS many FROM nodes) WHERE many > 1
  GROUP BY tree, level, n // 2),
subroots AS (SELECT tree, arg_max(h, level) AS subroot, max(level) AS top FROM nodes GROUP BY tree),
upper_nodes(level, n, h) AS (
  SELECT 0, tree, subroot FROM subroots
  UNION ALL
  SELECT level + 1, n // 2, sha256(string_agg(h, '' ORDER BY n))
  FROM (SELECT *, count(*) OVER () AS many FROM upper_nodes) WHERE many > 1
  GROUP BY level, n // 2),
upper_top AS (SELECT arg_max(h, level) AS root, max(level) AS top FROM upper_nodes),
folds(tree, i, level, h, beside) AS (
  SELECT tree, i, 0, changed, '' FROM leaves
  UNION ALL
  SELECT f.tree, f.i, f.level + 1,
         sha256(CASE WHEN (f.i >> f.level) % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.beside || coalesce(s.h, '')
  FROM folds f JOIN subroots r ON r.tree = f.tree
  LEFT JOIN nodes s ON s.tree = f.tree AND s.level = f.level AND s.n = xor(f.i >> f.level, 1)
  WHERE f.level < r.top),
done AS (SELECT f.* FROM folds f JOIN subroots r ON r.tree = f.tree AND r.top = f.level),
upper_folds(tree, i, level, h, beside) AS (
  SELECT tree, i, 0, h, beside FROM done
  UNION ALL
  SELECT f.tree, f.i, f.level + 1,
         sha256(CASE WHEN (f.tree >> f.level) % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.beside || coalesce(s.h, '')
  FROM upper_folds f JOIN upper_top t ON f.level < t.top
  LEFT JOIN upper_nodes s ON s.level = f.level AND s.n = xor(f.tree >> f.level, 1))
SELECT doc_id, leaf, subroot, root, sha256(f.beside) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN upper_top ON true
JOIN upper_folds f ON f.tree = leaves.tree AND f.i = leaves.i AND f.level = upper_top.top
"""

HARD_NEGATIVES = """
WITH candidates AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.r, c.vec_id,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM candidates a JOIN candidates c ON a.vec_id % 100 = 0 AND a.r <> c.r AND len(a.v) = len(c.v)),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS FIRST, r) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS FIRST, n.r) AS INTEGER) AS rank
  FROM positives p JOIN scores n
    ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
