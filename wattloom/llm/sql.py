"""DuckDB SQL for the queries that SQL can express."""

from wattloom.llm.rule_ledger import BITS, POLICIES, RULES
from wattloom.llm.warc import STEPS

_BLANK = r"E' \t\n\x0b\x0c\r'"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS k FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT keyed.*, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {BITS[name]} ELSE 0 END"
                   for name, rule in RULES.items())
_POLICY = {p: sum(BITS[r] for r in rules) for p, rules in POLICIES.items()}

RULE_LEDGER = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (
  SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p
        FROM windows SEMI JOIN twice USING (doc_id, win)) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_alpha_words,
         len(list_filter(w, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]')
                                 AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, {_BITS} AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & {_POLICY["v1"]}) <> 0 AS base_failed,
       (failures & {_POLICY["v1"]}) = 0 AND (failures & {_POLICY["v2"]}) = 0 AS kept,
       failures::BIGINT AS failures
FROM f
"""

CONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain(column: str) -> str:
    for pattern, text in STEPS:
        new = "chr(10)" if text == "\n" else _literal(text)
        column = f"regexp_replace({column}, {_literal(pattern)}, {new}, 'g')"
    return f"trim({column}, ' ' || chr(10))"


def _record_id(kind: str, digest: str) -> str:
    h = f"sha256(coalesce(page_id::VARCHAR, '') || '|' || u || '|{kind}|' || {digest})"
    parts = " || '-' || ".join(f"substring({h}, {a}, {n})" for a, n in
                               ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {parts} || '>'"


WARC = f"""
WITH a AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h,
         {_plain("coalesce(html, '')")} AS t FROM pages),
b AS (SELECT *, 'sha256:' || sha256(h) AS hd, 'sha256:' || sha256(t) AS td FROM a),
c AS (SELECT *, {_record_id("response", "hd")} AS rid, {_record_id("conversion", "td")} AS cid FROM b),
e AS (SELECT *, 'source-type: text/html' || chr(10) || 'source-digest: ' || hd || chr(10)
             || 'source-length: ' || strlen(h) || chr(10) || 'conversion: ' || cid || chr(10) AS f
      FROM c),
g AS (SELECT *, 'sha256:' || sha256(f) AS fd FROM e),
r AS (SELECT *, {_record_id("metadata", "fd")} AS mid FROM g)
SELECT page_id, u AS target_uri, 'response' AS record_type, rid AS record_id,
       NULL::VARCHAR AS refers_to, 'text/html' AS content_type, hd AS payload_digest,
       strlen(h) AS content_length, h AS content FROM r
UNION ALL
SELECT page_id, u, 'conversion', cid, rid, 'text/plain', td, strlen(t), t FROM r
UNION ALL
SELECT page_id, u, 'metadata', mid, rid, 'application/warc-fields', fd, strlen(f), f FROM r
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({_LOWER.format("coalesce(text, '')")},
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (
  SELECT lang, array_to_string(w[i:i + d - 1], ' ') AS phrase, d
  FROM starts, (VALUES (1), (2), (3), (4)) sizes(d) WHERE i + d - 1 <= len(w)),
f AS (SELECT lang, phrase, d, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE d = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE n >= 30),
cuts AS (
  SELECT lang, phrase, n AS a, d, w, unnest(range(1, d)) AS k FROM often WHERE d >= 2),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.n AS l, r.n AS r,
         (2000000 * c.a::HUGEINT) // (l.n::HUGEINT + r.n) AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.d], ' ')),
weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (
  SELECT lang, w, n, d, unnest(range(1, d + 1)) AS i FROM often WHERE d >= 3),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(n) AS most,
         count(*) FILTER (m = d - 1 AND i = 2) AS left_words,
         count(*) FILTER (m = d - 1 AND i = 1) AS right_words
  FROM spans, (VALUES (2), (3)) sizes(m) WHERE m < d AND i + m - 1 <= d GROUP BY ALL)
SELECT lang, row_number() OVER (
         PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, totals.n::BIGINT AS n, score::BIGINT AS score,
       coalesce(left_words, 0) AS left_words, coalesce(right_words, 0) AS right_words
FROM weakest LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT
QUALIFY rank <= 2000
"""

_FAR = "(({0} - {1}) * ({0} - {1})) // ({0} + {1})"

DIVERGENCE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
words AS (
  SELECT doc_id, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (
  SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.term, count(w.doc_id) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN words w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term GROUP BY ALL),
p AS (
  SELECT *, 1 + (1000000000 * (n + 2)::HUGEINT)
         // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM dense),
lang_n AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL),
q AS (
  SELECT lang, term, 1 + (1000000000 * (n + 2)::HUGEINT)
         // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM lang_n),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum({_FAR.format("a.p", "b.p")}) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
above AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, {_FAR.format("p.p", "q.q")} AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p.p > q.q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM above))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
