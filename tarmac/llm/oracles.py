"""DuckDB SQL for the operators that SQL can express; the others are tested by brute force."""

from __future__ import annotations

DECONTAMINATION = r"""
WITH fold AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
item_window AS (
  SELECT DISTINCT item, k, array_to_string(w[i + 1:i + k], ' ') AS s
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(len(w) - least(13, len(w)) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM item_window),
doc_window AS (
  SELECT doc_id, i, k, array_to_string(w[i + 1:i + k], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM fold, sizes WHERE len(w) >= k)),
hit AS (SELECT d.doc_id, d.i, d.k, m.item FROM doc_window d JOIN item_window m USING (k, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT f.doc_id, len(f.w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.names, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(f.w) AS contaminated
FROM fold f LEFT JOIN covered c USING (doc_id) LEFT JOIN items t USING (doc_id)
"""

LINE_DEDUP = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS r FROM documents),
solid AS (
  SELECT doc_id, r, line, greatest(len(line) - len(replace(line, ' ', '')) + 1, strlen(line) // 20) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY r) AS i
  FROM raw WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
pairs AS (
  SELECT a.doc_id, a.i, a.n, b.doc_id AS earlier, a.i - b.i AS lead
  FROM solid a JOIN solid b ON a.line = b.line AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.i < a.i))),
stretches AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, earlier, lead ORDER BY i) AS s FROM pairs),
repeats AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM stretches GROUP BY doc_id, earlier, lead, s HAVING sum(n) >= 10),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM repeats),
marked AS (SELECT s.*, g.i IS NOT NULL AS gone FROM solid s LEFT JOIN gone g USING (doc_id, i)),
islands AS (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run, count(*) OVER (PARTITION BY doc_id) AS total FROM marked WHERE gone),
runs AS (SELECT doc_id, sum(n)::BIGINT AS n_deleted, count(*) AS n_runs, max(n) AS longest_run FROM (SELECT doc_id, run, count(*) AS n FROM islands GROUP BY ALL) GROUP BY doc_id),
lines AS (
  SELECT r.doc_id, r.r, r.line,
    coalesce(m.gone, coalesce(last_value(m.gone IGNORE NULLS) OVER (PARTITION BY r.doc_id ORDER BY r.r ROWS UNBOUNDED PRECEDING), false)
      AND coalesce(first_value(m.gone IGNORE NULLS) OVER (PARTITION BY r.doc_id ORDER BY r.r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), false)) AS gone
  FROM raw r LEFT JOIN marked m ON m.doc_id = r.doc_id AND m.r = r.r),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY r) AS t FROM lines WHERE NOT gone GROUP BY doc_id),
size AS (SELECT doc_id, count(*) AS n FROM solid GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_lines, coalesce(u.n_deleted, 0) AS n_deleted, coalesce(u.n_runs, 0) AS n_runs, coalesce(u.longest_run, 0) AS longest_run,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents d LEFT JOIN size s USING (doc_id) LEFT JOIN runs u USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE fold AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + least(5, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM fold WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT DISTINCT a AS s, a AS t FROM edge UNION SELECT r.s, e.b FROM reach r JOIN edge e ON e.a = r.t)
SELECT f.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, f.doc_id) AS component_id
FROM fold f LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT s AS doc_id, min(t) AS c FROM reach GROUP BY s) c USING (doc_id)
"""


#: crc32 is not a function there: the fold of a string's bytes, bit by bit.
CONVERSATION_TRIE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST, m) AS s,
    xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda a, b: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)), 4294967295), 4294967295) % 9 AS h
  FROM t GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.s[1:o.h], []), o.s[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
member AS (SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends, CASE WHEN d > 0 THEN strlen(s[d].x) ELSE 0 END AS bytes FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT d, p, min(conv_id) AS c, count(*) AS n, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS h
  FROM member GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS k FROM node WHERE d > 0 GROUP BY ALL),
sub AS (
  SELECT a.d, a.p, sum((b.n - 1) * b.bytes) AS saved, count(*) FILTER (k.k IS NULL) AS leaves
  FROM (SELECT d, p, n, bytes, unnest(range(d + 1)) AS up FROM node) b
  JOIN node a ON a.d = b.up AND a.p = b.p[1:b.up] LEFT JOIN kids k ON k.d = b.d AND k.p = b.p GROUP BY a.d, a.p)
SELECT n.c AS conv_id, n.d AS depth, u.c AS parent_conv_id, n.n AS n_convs, coalesce(k.k, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.h AS ends_sha256
FROM node n JOIN sub s USING (d, p) LEFT JOIN kids k USING (d, p) LEFT JOIN node u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""


PHRASES = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
  FROM documents),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS size(k) WHERE len(w) >= k)
  GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
cut AS (
  SELECT c.lang, c.p, c.a, c.i, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.w[1:c.i], ' ')
  JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.w[c.i + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, i) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS p, max(a) AS outer_a
  FROM (SELECT *, unnest(range(1, k - n + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS n FROM cand)) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside o USING (lang, p) WHERE o.outer_a IS NULL OR 100::HUGEINT * o.outer_a < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def registry() -> dict[str, str]:
    return {"op6_decontamination": DECONTAMINATION, "op8_line_dedup": LINE_DEDUP, "op10_ngram_join": NGRAM_JOIN, "op11_conversation_trie": CONVERSATION_TRIE, "op13_phrases": PHRASES}
