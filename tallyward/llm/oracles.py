"""SQL of the queries that SQL can express."""

_OP7 = r"""
WITH RECURSIVE w AS (
 SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
s AS (
 SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = d.doc_id
"""

_OP8 = r"""
WITH d AS (
 SELECT doc_id, source, md5(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS number,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, cast(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s),
v AS (
 SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER e, 0))::DOUBLE
   / (sum(w) OVER () - coalesce(sum(w) OVER e, 0))::DOUBLE AS level
 FROM r WINDOW e AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, max(level) OVER () * w) AS target FROM v),
c AS (
 SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
  ('0x' || substr(md5(concat_ws(':', 'mix', coalesce(cast(d.doc_id AS VARCHAR), ''), digest, cast(number AS VARCHAR))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS coin
 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, cast(size AS BIGINT) AS size, source_size, target,
 cast(size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11 = rf"""
WITH d AS (
 SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
 SELECT d.lang, d.source, coalesce(s.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) d
 LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source) s ON s.lang = d.lang AND s.source = d.source),
p AS (
 SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v.v) AS p,
  1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v) AS q
 FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
 SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (
 SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
 UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM r)
SELECT lang, source, part, item, cast(value AS BIGINT) AS value, cast(k AS INTEGER) AS rank FROM o WHERE part = 'pair' OR k <= 50
"""

_OP12 = r"""
WITH t AS (
 SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
 cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
 sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
 cast(sum(length('<turn >' || role || chr(10) || regexp_replace(text, '(\\|</?turn)', '\\\1', 'g') || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_OP13 = rf"""
WITH d AS (
 SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
 FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) z WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS a FROM s GROUP BY lang, phrase, k HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT c.lang, c.phrase, c.a, j.j AS cut, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
 FROM c JOIN (SELECT unnest([1, 2, 3]) AS j) j ON j.j < c.k
 JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j.j], ' ')
 JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j.j + 1:c.k], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT c.lang, array_to_string(c.w[p.j:p.j + m.j - 1], ' ') AS phrase, max(c.a) AS longer
 FROM c, (SELECT unnest([2, 3]) AS j) m, (SELECT unnest([1, 2, 3]) AS j) p WHERE m.j < c.k AND p.j + m.j - 1 <= c.k GROUP BY 1, 2),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
 FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, n.n, cast(o.score AS BIGINT) AS score FROM o JOIN n ON n.lang = o.lang WHERE o.rank <= 2000
"""

SQL = {"op11_source_divergence": _OP11, "op12_chat_format": _OP12, "op13_phrase_collocations": _OP13, "op8_source_mix": _OP8, "op7_ngram_jaccard_join": _OP7}
