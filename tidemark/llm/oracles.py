"""SQL of the queries that SQL can express, for the engine that checks them."""

from __future__ import annotations

from tidemark.llm.quality_rules import STOP_WORDS

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_STOP = ", ".join(
    "'" + form + "'" for form in sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})
)

QUALITY_RULES = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows SEMI JOIN again USING (doc_id, g))
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(l)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words,
         len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper
  FROM d LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, list_filter([
      CASE WHEN 100 * n_words < 5000 THEN 'few_words' END,
      CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END], lambda x: x IS NOT NULL) AS base,
    list_filter([
      CASE WHEN 100 * word_chars < 200 * n_words THEN 'short_words' END,
      CASE WHEN 100 * word_chars > 1500 * n_words THEN 'long_words' END,
      CASE WHEN 100 * n_symbols > 10 * n_words THEN 'symbols' END,
      CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 'repeated_lines' END,
      CASE WHEN 100 * n_stop_words < 2 * n_words THEN 'stop_words' END,
      CASE WHEN 100 * n_upper > 40 * word_chars THEN 'shouting' END], lambda x: x IS NOT NULL) AS rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       len(base) > 0 AS base_failed, len(base) = 0 AND len(rules) = 0 AS kept,
       array_to_string(base || rules, ',') AS failed
FROM f
"""

_SIZE = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT"
_SEEDED = "md5('17:{salt}:' || coalesce(doc_id::VARCHAR, 'null'))"

# Seats by the highest quotients, all written out.
MIXING = f"""
WITH d AS (SELECT doc_id, source, {_SIZE} AS size FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size, count(*) AS n_docs FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
             ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS weight FROM s),
l AS (SELECT *, 3 * source_size AS most, row_number() OVER v AS level_place,
             (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER
               (v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (v ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
      FROM p WINDOW v AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, place)),
free AS (SELECT * FROM l WHERE rest * weight <= most * weight_left ORDER BY level_place LIMIT 1),
t AS (SELECT l.*, CASE WHEN l.level_place < f.level_place THEN l.most::DOUBLE
                       ELSE f.rest::DOUBLE * l.weight::DOUBLE / f.weight_left::DOUBLE END AS target,
             greatest(1, ceil((l.source_size + l.n_docs * 100)::DOUBLE / 1000000))::BIGINT AS shards
      FROM l, free f),
b AS (SELECT least(16, greatest(1, floor(sum(source_size)::DOUBLE / (count(*) * 1000))))::BIGINT AS block,
             sum(source_size)::BIGINT AS total FROM s),
q AS (SELECT source, target / (2 * unnest(range(0, (target / block)::BIGINT + 50)) + 1) AS quotient FROM t, b),
w AS (SELECT source, quotient, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS rank FROM q),
seats AS (SELECT source, count(*) FILTER (rank <= total // block) AS blocks FROM w, b GROUP BY source),
x AS (SELECT d.*, t.source_size, t.target, seats.blocks,
             ('0x' || substr({_SEEDED.format(salt="shard")}, 1, 8))::BIGINT % shards AS shard,
             {_SEEDED.format(salt="order")} AS turn
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
      JOIN seats ON d.source IS NOT DISTINCT FROM seats.source),
c AS (SELECT source, shard, sum(size)::BIGINT AS cell_size, any_value(blocks) AS blocks FROM x GROUP BY source, shard),
cq AS (SELECT source, shard, blocks, cell_size / (2 * unnest(range(0, blocks + 1)) + 1) AS quotient FROM c),
cw AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) AS rank FROM cq),
cells AS (SELECT c.*, won, least(won * block, 3 * cell_size) AS words
          FROM c JOIN (SELECT source, shard, count(*) FILTER (rank <= blocks) AS won FROM cw GROUP BY source, shard) n
            ON c.source IS NOT DISTINCT FROM n.source AND c.shard = n.shard, b),
y AS (SELECT x.*, won, words, cell_size,
             sum(size) OVER (PARTITION BY x.source, x.shard ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
      FROM x JOIN cells ON x.source IS NOT DISTINCT FROM cells.source AND x.shard = cells.shard)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (CASE WHEN cell_size = 0 THEN 0 ELSE words // cell_size * size
         + greatest(0, least(size, words % cell_size - before)) END)::BIGINT AS taken,
       shard, won::BIGINT AS shard_blocks
FROM y
"""

LINE_DEDUP = """
WITH l AS (
  SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, first IS NOT NULL AND doc_id <> first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

NEAR_DUP = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS label FROM d UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(label) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM v),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE again),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
j AS (SELECT k.*, gone.p IS NULL AS stays FROM k LEFT JOIN gone USING (doc_id, p)),
s AS (SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (stays) AS kept FROM j GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""

# Pattern, place, kind, points, words nearby, check of a proposal.
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_KINDS = [
    ("[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "email", 80, "mail|contact|write", "true"),
    ("[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", "ip", 60, "ip|host|server|address",
     "len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR ('0' || right(ltrim(p, '0'), 3))::INT > 255)) = 0"),
    ("[0-9]([\\x20-]?[0-9])+", "card", 80, "card|visa|carte|karte|tarjeta", f"""
     length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
       CASE WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INT
            ELSE (2 * substr(reverse({_DIGITS}), i, 1)::INT) % 10 + (2 * substr(reverse({_DIGITS}), i, 1)::INT) // 10 END)) % 10 = 0"""),
    ("\\+[0-9][\\x20().0-9-]+[0-9]", "phone", 60, "phone|tel|call|fax|mobil", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    ("[A-Z][A-Z][0-9][0-9](\\x20?[A-Z0-9]){11,30}", "iban", 80, "iban|account|bank|konto|compte|cuenta", """
     NOT regexp_matches(prior, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND list_reduce(
       list_transform(string_split(array_to_string(list_transform(string_split(substr(replace(hit, ' ', ''), 5) || substr(hit, 1, 4), ''), lambda c:
         CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END), ''), ''), lambda x: x::INT), lambda a, b: (a * 10 + b) % 97) = 1"""),
    ("\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[.-][0-9]{4}", "local", 30, "phone|tel|call|fax|mobil", """
     NOT regexp_matches(prior, '[0-9+.-]$') AND NOT regexp_matches(after, '^[0-9+.-]') AND NOT regexp_matches(prior, '\\+[0-9][\\x20().0-9-]*$')"""),
    ("[0-9]{3}-[0-9]{2}-[0-9]{4}", "number", 30, "ssn|social security|tax id",
     "NOT regexp_matches(prior, '[0-9+.-]$') AND NOT regexp_matches(after, '^[0-9+.-]')"),
]
_PROPOSALS = " UNION ALL ".join(
    f"""
  SELECT r, place, kind, hit, start, start + length(hit) AS stop, points + CASE WHEN regexp_matches(translate(prior,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:{words})') THEN 40 ELSE 0 END AS score
  FROM (SELECT r, {place} AS place, '{kind}' AS kind, {points} AS points, h[i] AS hit, right(g[i], 30) AS prior,
               left(g[i + 1] || coalesce(h[i + 1], ''), 1) AS after,
               list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT r, g, h, unnest(range(1, len(h) + 1)) AS i
              FROM (SELECT r, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS h FROM d)))
  WHERE {check}"""
    for place, (pattern, kind, points, words, check) in enumerate(_KINDS)
)
PII = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p AS ({_PROPOSALS}),
s AS (
  SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM p WHERE place < 4 OR score >= 70 GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ("email", "ip", "card", "phone"))},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (r)
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
COLLOCATIONS = f"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLDED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 6) AS t(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 100),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c b ON s.lang = b.lang AND b.k > s.k
           AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * b.f >= 100 * s.f),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS first, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c ANTI JOIN gone USING (lang, phrase))),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN n USING (lang) JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

_TERMS = f"regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
RANKED_SEARCH = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ws FROM documents),
d AS (SELECT r, doc_id, ws, len(ws)::BIGINT AS n FROM t WHERE len(ws) > 0),
s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS w FROM benchmark),
tf AS (SELECT r, doc_id, n, w, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS w FROM d) SEMI JOIN q USING (w) GROUP BY ALL),
df AS (SELECT w, floor(1000 * ln((2 * (SELECT nd FROM s) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf GROUP BY w),
p AS (SELECT r, doc_id, w, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))) AS impact FROM tf JOIN df USING (w), s),
x AS (SELECT item_id, r, doc_id, sum(impact)::BIGINT AS score FROM q JOIN p USING (w) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50
"""

ORACLES = {
    "op1_near_dup": NEAR_DUP,
    "op2_quality_rules": QUALITY_RULES,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op5_mixing": MIXING,
    "op9_line_dedup": LINE_DEDUP,
    "op8_topk": TOPK,
    "op11_pii": PII,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_collocations": COLLOCATIONS,
}
