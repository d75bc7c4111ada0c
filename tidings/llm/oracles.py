"""DuckDB SQL for the queries whose whole result SQL can express.

Written with literals, so that a change of a parameter in the library turns a comparison red.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')"

_CHATS = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '\### Assistant: </turn> ok'),
                   (-7::BIGINT, 1::BIGINT, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *, length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars,
    length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars,
    replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS escaped
  FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, escaped) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                        ORDER BY turn NULLS FIRST, role, escaped), '') AS loss,
    sum(7 + role_chars + text_chars + 8)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM c
"""

_NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), i AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS x0, unnest(range(len(w))) AS place FROM d
), g AS (
  SELECT doc_id, n, place, x0, lead(x0, 1) OVER p AS x1, lead(x0, 2) OVER p AS x2, lead(x0, 3) OVER p AS x3,
    lead(x0, 4) OVER p AS x4
  FROM i WINDOW p AS (PARTITION BY doc_id ORDER BY place)
), s AS (
  SELECT DISTINCT doc_id, concat_ws(' ', x0, x1, x2, x3, x4) AS x FROM g WHERE place + 5 <= n OR (place = 0 AND n < 5)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_QUALITY = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^ \x09-\x0D]')] AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), twice AS (SELECT doc_id, x FROM g GROUP BY ALL HAVING count(*) > 1),
q AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT g.doc_id, unnest([i, i + 1, i + 2]) AS place FROM g JOIN twice USING (doc_id, x)) GROUP BY doc_id
), m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(q.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN q USING (doc_id)
), f AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
    10 * n_symbols > n_words AS f3, n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines AS f4
  FROM m
), h AS (
  SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS rule,
    unnest([sum(f1::INT), sum(f2::INT), sum(f3::INT), sum(f4::INT)]) AS f
  FROM f GROUP BY source
), b AS (SELECT rule, avg(f / n) AS mean, var_pop(f / n) AS var FROM h GROUP BY rule),
v AS (
  SELECT source, bool_or((f + mean * k) / (n + k) > 0.5) AS rejected
  FROM (SELECT *, CASE WHEN var > 0 THEN greatest(mean * (1 - mean) / var - 1, 1.0) ELSE 1.0 END AS k
        FROM h JOIN b USING (rule)) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT rejected AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), x AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT k) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT s.lang, s.source, coalesce(t.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) s
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) t USING (lang, source)
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (kept.n + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""

ORACLES = {
    "op4_chats": _CHATS,
    "op5_near_duplicates": _NEAR_DUPLICATES,
    "op6_quality": _QUALITY,
    "op13_divergence": _DIVERGENCE,
}
