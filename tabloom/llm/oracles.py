"""DuckDB texts of the queries that SQL can express on small tables."""

from __future__ import annotations

OP7_SQL = r"""
WITH raw AS (
 SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS idx,
  unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS b FROM raw),
parsed AS (
 SELECT *, length(b) - length(replace(b, ' ', '')) + 1 AS n, regexp_replace(b, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked,
  regexp_replace(array_to_string(string_split(b, ' ')[1:3], ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS head
 FROM bare),
counts AS (
 SELECT n, head, masked, count(*) AS texts
 FROM (SELECT DISTINCT text, n, head, masked FROM parsed WHERE n >= 3) GROUP BY ALL),
placed AS (
 SELECT n, head, masked, texts, generate_subscripts(string_split(masked, ' '), 1) AS pos,
  unnest(string_split(masked, ' ')) AS token FROM counts),
constants AS (
 SELECT n, head, pos, token FROM placed WHERE token <> '<*>' GROUP BY ALL HAVING sum(texts) >= 5),
templates AS (
 SELECT p.n, p.head, p.masked, p.texts, list({'pos': p.pos, 'token': p.token} ORDER BY p.pos) AS pattern
 FROM placed p JOIN constants USING (n, head, pos, token)
 GROUP BY ALL HAVING count(*) >= CAST(0.7 AS DOUBLE) * p.n),
shared AS (SELECT n, head, pattern FROM templates GROUP BY ALL HAVING sum(texts) >= 5),
recurring AS (
 SELECT masked FROM counts WHERE texts >= 5
  AND n - (length(masked) - length(replace(masked, '<*>', ''))) // 3 >= CAST(0.7 AS DOUBLE) * n
 UNION SELECT t.masked FROM templates t JOIN shared USING (n, head, pattern)),
marked AS (SELECT *, n >= 3 AND masked IN (SELECT masked FROM recurring) AS gone FROM parsed),
cut AS (
 SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (gone) AS n_gone,
  coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (NOT gone), '') AS rest
 FROM marked GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines,
 CASE WHEN length(c.rest) < 0.5 * length(c.text) THEN 0 ELSE coalesce(c.n_gone, 0) END AS n_dropped,
 sha256(CASE WHEN length(c.rest) < 0.5 * length(c.text) THEN c.text ELSE c.rest END) AS kept_sha256
FROM documents d LEFT JOIN cut c USING (doc_id)
"""

OP6_SQL = r"""
WITH d AS (
 SELECT doc_id, lang, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM d),
windows AS (
 SELECT doc_id, pos, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS five,
  lead(word, 4) OVER o IS NOT NULL AS full_window FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
 SELECT doc_id, pos FROM windows WHERE full_window QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words FROM twice, range(5) r(k) GROUP BY doc_id),
lines AS (
 SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
 FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
 WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
 SELECT d.doc_id, d.lang, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
 FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
measured AS (
 SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  [n_symbols / greatest(n_words, 1), n_capitals / greatest(word_chars, 1), n_dup_lines / greatest(n_lines, 1),
   n_repeat_words / greatest(n_words, 1)] AS measures FROM m),
good AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
holdout AS (
 SELECT lang, t, max(good) AS good, any_value(measures) AS measures
 FROM measured JOIN good USING (doc_id) GROUP BY lang, t),
cutoffs AS (SELECT CAST(j AS INTEGER) AS pos, 4.0::DOUBLE * power(0.8::DOUBLE, j) AS cutoff FROM range(28) r(j)),
counts AS (
 SELECT lang, rule, pos, cutoff, count(*) FILTER (good = 1) AS n,
  count(*) FILTER (good = 1 AND measures[rule] > cutoff) AS k, count(*) FILTER (good <> 1 AND measures[rule] > cutoff) AS bad
 FROM holdout, (SELECT unnest([1, 2, 3, 4]) AS rule), cutoffs GROUP BY ALL),
tested AS (
 SELECT *, (SELECT sum(exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n - i + 1)
   + i * ln(0.005) + (n - i) * ln(0.995)))
  FROM unnest(range(0, CASE WHEN k < n * 0.005 THEN k + 1 ELSE 0 END)) u(i)) AS cdf FROM counts),
chosen AS (
 SELECT lang, rule, arg_min(cutoff, -bad * 100 + pos) AS cutoff FROM tested
 WHERE k < n * 0.005 AND cdf <= 0.05 / (4 * (SELECT count(DISTINCT coalesce(lang, '?')) FROM holdout)) GROUP BY lang, rule),
failed AS (
 SELECT DISTINCT doc_id FROM measured JOIN chosen ON measured.lang IS NOT DISTINCT FROM chosen.lang
 WHERE measures[rule] > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM measured
"""

# All pairs.
OP10_SQL = """
WITH RECURSIVE good AS (
 SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
 SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
 ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(s.b, e.vec_id)) AS component_id,
 e.vec_id = least(e.vec_id, coalesce(s.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN smallest s ON s.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""

# Every entry compared, in integers. ``assign`` and ``move`` are the two halves of a round.
_OP11_ASSIGN = """
near{i} AS (
 SELECT vec_id, part, arg_min({{'entry': entry, 'd': d}}, d * 64 + entry) AS best FROM (
  SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM pieces p JOIN book{i} b USING (part)) GROUP BY ALL)"""
_OP11_MOVE = """
sums{i} AS (
 SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS n FROM (
  SELECT p.part, n.best.entry AS entry, unnest(p.x) AS v, unnest(range(1, len(p.x) + 1)) AS pos
  FROM pieces p JOIN near{i} n USING (vec_id, part)) GROUP BY ALL),
moved{i} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM sums{i} GROUP BY ALL),
book{j} AS (SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN moved{i} m USING (part, entry))"""
OP11_SQL = (
    """
WITH good AS (
 SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (
 SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x
 FROM good, (SELECT unnest(range(16)) AS part)),
book0 AS (
 SELECT part, entry, x FROM pieces JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM good ORDER BY vec_id LIMIT 64) USING (vec_id)),"""
    + ",".join(_OP11_ASSIGN.format(i=i) + "," + _OP11_MOVE.format(i=i, j=i + 1) for i in range(2))
    + ","
    + _OP11_ASSIGN.format(i=2)
    + """,
coded AS (
 SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
 FROM near2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN good USING (vec_id), books
"""
)

# Every source against every other, over all kept terms.
OP12_SQL = r"""
WITH d AS (
 SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
row AS (SELECT row_number() OVER () AS r, lang, source, words FROM d),
places AS (SELECT r, lang, source, unnest(words) AS term FROM row),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM places GROUP BY ALL HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM places JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
 SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
  1 + (1000000000 * (k.n + 5)) // (l.total + 5 * l.v) AS q
 FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
 LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
 LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
differences AS (
 SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
 FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
 SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN differences f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM more
QUALIFY rank <= 50
"""
