"""The results of operators that SQL can state, as DuckDB statements over the bundled tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM places JOIN win USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id),
at_doc AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM dw),
at_item AS (SELECT item_id, unnest(w) AS word, unnest(range(len(w))) AS j FROM iw),
pairs AS MATERIALIZED (SELECT doc_id, item_id, i, i - j AS diagonal FROM at_doc JOIN at_item USING (word)),
runs AS (
  SELECT doc_id, min(i) AS first, count(*) AS n FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, item_id, diagonal, island),
far AS (SELECT doc_id, max(n) AS longest, arg_min(first, (-n, first)) AS longest_at FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(longest, 0) AS longest, CAST(longest_at AS BIGINT) AS longest_at
FROM dw d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN far USING (doc_id)
"""

_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$"""


def _found(number: int, kind: str, pattern: str) -> str:
    """Matches with their places: the text before the match is the pieces and matches before it."""
    return f"""
  SELECT doc_id, source, {number} AS number, '{kind}' AS kind, m[i] AS token,
    CAST(list_sum([length(x) for x in p[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, source, m, p, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, source, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM documents) WHERE len(m) > 0)"""


SECRETS = f"""
WITH every AS ({_found(0, "assign", _ASSIGN)} UNION ALL {_found(1, "access", "AKIA[A-Z0-9]+")} UNION ALL {_found(2, "hex", "[0-9a-f]+")}
  UNION ALL {_found(3, "owned", "[A-Za-z0-9+/_=-]+")}),
spans AS (
  SELECT *, start + length(token) AS stop, CASE WHEN kind = 'assign' THEN regexp_extract(token, '{_VALUE}', 1) ELSE token END AS value FROM every),
base AS (
  SELECT * FROM spans WHERE (kind = 'assign' AND length(value) >= 6) OR (kind = 'access' AND length(token) >= 20) OR (kind = 'hex' AND length(token) >= 24)),
free AS (
  SELECT * FROM spans s WHERE kind = 'owned' AND length(token) >= 20 AND regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Za-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND s.start < b.stop AND b.start < s.stop)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM free),
few AS (
  SELECT value FROM (SELECT DISTINCT value, source, doc_id FROM found) GROUP BY value
  HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) <= 1 AND count(*) <= 8),
marked AS (SELECT *, value IN (SELECT value FROM few) AS live, kind || ':' || start || ':' || stop AS line FROM found),
per AS (
  SELECT doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex,
    string_agg(line, ',' ORDER BY start, number) FILTER (number < 3) AS base,
    string_agg(line, ',' ORDER BY start, number) FILTER (number < 3 OR live) AS spans,
    count(*) FILTER (number < 3 AND live) AS n_live, count(*) FILTER (number = 3 AND live) AS n_owned
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_owned, 0) AS n_owned
FROM documents d LEFT JOIN per USING (doc_id)
"""

REPEATS = """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, array_slice(raw, i + 1, i + 50) AS k FROM (SELECT doc_id, raw, unnest(range(0, n - 49)) AS i FROM t)),
c AS (SELECT doc_id, i FROM w JOIN (SELECT k, min(doc_id) AS first FROM w GROUP BY k) USING (k) WHERE first < doc_id),
s AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span
  FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM c)),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM s GROUP BY doc_id, span),
kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS lo, a AS hi FROM r
  UNION ALL SELECT t.doc_id, coalesce(max(b), 0), any_value(n) FROM t LEFT JOIN r USING (doc_id) GROUP BY t.doc_id),
k AS (SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo))) AS kept_sha256 FROM kept JOIN t USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT t.doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM t JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_RUNS = f"regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')"

# The checksum takes a byte in each step, by a table that is built from its polynomial.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest({_RUNS}) AS run FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run),
coded AS (
  SELECT row_number() OVER () AS id, run, times,
    list_concat([CAST(ord(x) AS BIGINT) for x in string_split(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':', '')],
      flatten([CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [192 + (CAST(ord(x) AS BIGINT) >> 6), 128 + (CAST(ord(x) AS BIGINT) & 63)] END
        for x in string_split(run, '')])) AS bytes
  FROM runs),
tab AS (
  SELECT CAST(c AS BIGINT) AS c, list_reduce(list_prepend(CAST(c AS BIGINT), [CAST(b AS BIGINT) for b in range(8)]),
    lambda x, b: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS folded
  FROM (SELECT unnest(range(256)) AS c)),
step AS (
  SELECT id, 1 AS k, 4294967295::BIGINT AS crc FROM coded
  UNION ALL
  SELECT s.id, k + 1, xor(s.crc >> 8, tab.folded) FROM step s JOIN coded USING (id) JOIN tab ON tab.c = xor(s.crc, bytes[k]) & 255 WHERE k <= len(bytes)),
summed AS (SELECT id, run, times, xor(crc, 4294967295) AS h FROM step JOIN coded USING (id) WHERE k = len(bytes) + 1),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 31 <> 0 THEN run ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, less) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, encode(other))) AS other FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN other END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS tip FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, form FROM chain JOIN forms f ON f.word = chain.tip WHERE f.form IS NOT NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n
FROM forms f LEFT JOIN (SELECT chain.word, tip AS root FROM chain JOIN forms l ON l.word = chain.tip WHERE l.form IS NULL) r USING (word)
"""
