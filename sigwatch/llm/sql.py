"""DuckDB SQL for the operators that SQL can express."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACE_WORDS = rf"regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw USING (n, gram)),
hitwords AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hitwords USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
u AS (
  SELECT doc_id, i, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS a,
         sum(CASE WHEN line <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS unit_no
  FROM l),
n AS (
  SELECT doc_id, unit_no, a, length(line) AS size, regexp_extract_all(lower(line), '[^\s]+') AS w FROM u WHERE line <> ''),
k AS (
  SELECT *, array_to_string(w, ' ') AS key FROM n WHERE len(w) >= 5),
f AS (
  SELECT *, first_value(doc_id) OVER o AS kept_doc_id, first_value(unit_no) OVER o AS kept_unit_no, row_number() OVER o AS r
  FROM k WINDOW o AS (PARTITION BY key ORDER BY doc_id, unit_no))
SELECT doc_id, unit_no::BIGINT AS unit_no, a::BIGINT AS start, (a + size)::BIGINT AS "end", len(w)::BIGINT AS n_words,
       kept_doc_id, kept_unit_no::BIGINT AS kept_unit_no
FROM f WHERE r > 1
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY n, digest) AS response FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> response THEN response END AS refers_to
FROM g
"""

PARITY_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM r JOIN both_ways x ON r.b = x.a)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""

#: Words that lie in a 50-word window standing earlier, joined to passages.
#: Tokens alternate between words and white space, so lengths give the places.
PASSAGES = rf"""
WITH d AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (
  SELECT doc_id, i, first_value(doc_id) OVER o AS kept_doc_id, first_value(i) OVER o AS kept, row_number() OVER o AS r
  FROM g WINDOW o AS (PARTITION BY gram ORDER BY doc_id, i)),
m AS (
  SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM f WHERE r > 1),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM m),
p AS (
  SELECT doc_id, min(i) AS a, max(i) + 49 AS b, arg_min(kept_doc_id, i) AS kept_doc_id, arg_min(kept, i) AS kept
  FROM s GROUP BY doc_id, island),
tok AS (
  SELECT doc_id, unnest(range(1, len(t) + 1)) AS j, unnest(t) AS t
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents
        WHERE doc_id IN (SELECT doc_id FROM p))),
spot AS (
  SELECT doc_id, j, regexp_matches(t, '^[^\x20\x09-\x0D]') AS word, length(t) AS n,
         sum(length(t)) OVER (PARTITION BY doc_id ORDER BY j) AS e FROM tok),
k AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i, e - n AS s, e FROM spot WHERE word)
SELECT p.doc_id, (a - 1)::BIGINT AS first_word, (b - a + 1)::BIGINT AS n_words, x.s::BIGINT AS start, y.e::BIGINT AS "end",
       kept_doc_id, (kept - 1)::BIGINT AS kept_word
FROM p JOIN k x ON x.doc_id = p.doc_id AND x.i = a JOIN k y ON y.doc_id = p.doc_id AND y.i = b
"""

EVERY_LINE = LINE_DEDUP.replace("len(w) >= 5", "len(w) >= 1")

ORACLE = {"op3_line_dedup": PASSAGES, "op3_line_units": LINE_DEDUP, "op3_every_line": EVERY_LINE, "op6_decontaminate": DECONTAMINATE, "op7_parity_join": PARITY_JOIN,
          "op10_warc_bundles": WARC}
