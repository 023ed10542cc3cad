"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
spread AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN spread s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

QUALITY_RULES = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM base)),
filled AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM lines WHERE bare <> '' GROUP BY doc_id),
judged AS (
  SELECT doc_id, length(bare) AS chars,
    regexp_matches(bare, '[.!?…。！？][\x22''”’»)\]]*$')
    AND len(regexp_split_to_array(bare, '\s[|»›•·>]\s')) < 4
    AND NOT regexp_matches(bare, '(?i)(all rights reserved|privacy policy|terms of (use|service)|accept (all )?cookies|uses cookies|javascript (is )?(disabled|required)|enable javascript|click here to|sign up for our newsletter|subscribe to our|lorem ipsum)')
    AND 10 * (length(bare) - length(translate(bare, '#*$%&|<>', ''))) <= length(bare)
    AND (length(regexp_replace(bare, '\P{L}+', '', 'g')) < 20 OR
      2 * length(regexp_replace(bare, '\P{Lu}+', '', 'g')) <= length(regexp_replace(bare, '\P{L}+', '', 'g')))
    AS fine
  FROM lines WHERE bare <> ''),
lost AS (
  SELECT doc_id, sum(chars) AS chars, coalesce(sum(chars) FILTER (WHERE NOT fine), 0) AS gone
  FROM judged GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(translate(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(f.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(l.gone, 0) AS gone, coalesce(l.chars, 0) AS chars
  FROM base LEFT JOIN filled f USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN lost l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (2 * gone > chars) AS kept
FROM measured
"""

BALL_TREE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

PERIODIC_RUNS = r"""
WITH base AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS digits,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
bytes AS (
  SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, list_prepend(CAST(4294967295 AS BIGINT),
    [CASE WHEN k % 8 = 0 THEN ascii(digits[k // 8 + 1]) ELSE 0 END for k in range(8 * length(digits))]) AS parts
  FROM base),
hashed AS (
  SELECT doc_id, w, n, xor(list_reduce(parts, lambda c, b:
    xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) AS h
  FROM bytes),
planned AS (
  SELECT doc_id, w, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS r FROM hashed),
placed AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    [w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + r)) END) + 1] for i in range(n)] END AS w
  FROM planned),
word AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM placed),
pair AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM isle
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id
    ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM run),
gone AS (
  SELECT DISTINCT w.doc_id, w.i FROM word w JOIN run r
  ON w.doc_id = r.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS body
  FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id)
SELECT b.doc_id, coalesce(t.n_runs, 0) AS n_runs, r.start, r.length, r.period,
  1000 * r.length // r.period AS exponent_milli, sha256(coalesce(t.lines, '')) AS runs_sha256,
  sha256(coalesce(k.body, '')) AS collapsed_sha256
FROM base b LEFT JOIN told t USING (doc_id) LEFT JOIN ranked r ON r.doc_id = b.doc_id AND r.place = 1
LEFT JOIN kept k ON k.doc_id = b.doc_id
"""

SUPER_KMERS = r"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS content
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM base)),
bad AS (
  SELECT doc_id, i FROM win JOIN (SELECT content, min(doc_id) AS least FROM win GROUP BY content) USING (content)
  WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM bad, (SELECT unnest(range(50)) AS j)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM base),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS body, count(*) AS n
  FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id)
SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.body, '')) AS kept_sha256
FROM base b LEFT JOIN kept k ON k.doc_id = b.doc_id
"""

COVER_TREE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
anchors AS (SELECT * FROM rows WHERE vec_id % 50 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM anchors a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
    n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""

HYPER_MINHASH = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM base WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingled),
held AS (SELECT s FROM numbered GROUP BY s HAVING count(*) > 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM numbered x JOIN held USING (s) JOIN numbered y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sized p ON a = p.doc_id JOIN sized q ON b = q.doc_id
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
around AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS doc_id, a AS other FROM around
  UNION SELECT r.doc_id, n.b FROM reached r JOIN around n ON r.other = n.a),
component AS (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id)
SELECT b.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, b.doc_id) AS component_id,
  b.doc_id = coalesce(c.least, b.doc_id) AS kept
FROM base b LEFT JOIN sized s USING (doc_id) LEFT JOIN component c USING (doc_id)
"""

#: Bytes are pairs of hexadecimal digits.
SUFFIX_DEDUP = r"""
WITH base AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
-- Parts with the windows that begin at 500 bytes, as a place in a long text is found slowly.
part AS (
  SELECT doc_id, n, c, substr(h, 1000 * c + 1, 1398) AS p
  FROM (SELECT doc_id, h, n, unnest(range((n + 300) // 500)) AS c FROM base WHERE n >= 200)),
win AS (
  SELECT doc_id, 500 * c + j AS i, md5(substr(p, 2 * j + 1, 400)) AS k
  FROM (SELECT doc_id, c, p, unnest(range(least(500, n - 199 - 500 * c))) AS j FROM part)),
bad AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
-- Neighbouring windows overlap or touch; a gap of more than a window's length parts two spans.
marked AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, TRUE) AS first FROM bad),
grouped AS (
  SELECT doc_id, i, sum(CAST(first AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
span AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM grouped GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
left_over AS (
  SELECT e.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head,
    max(b) AS last, sum(b - a) AS removed, count(*) AS spans
  FROM edges e JOIN base USING (doc_id) GROUP BY e.doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(l.removed, 0) AS BIGINT) AS n_removed, coalesce(l.spans, 0) AS n_spans,
  sha256(unhex(coalesce(l.head, '') || substr(b.h, 2 * coalesce(l.last, 0) + 1))) AS kept_sha256
FROM base b LEFT JOIN left_over l USING (doc_id)
"""

ORACLES = {
    "op4_line_dedup": LINE_DEDUP,
    "op5_hyper_minhash": HYPER_MINHASH,
    "op6_quality_rules": QUALITY_RULES,
    "op9_suffix_dedup": SUFFIX_DEDUP,
    "op10_ball_tree": BALL_TREE,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op12_super_kmers": SUPER_KMERS,
    "op13_cover_tree": COVER_TREE,
}
