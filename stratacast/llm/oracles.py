"""The registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT item, w, least(len(w), 13) AS n FROM i WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM iw)
),
sizes AS (SELECT DISTINCT n FROM win),
keys AS (SELECT DISTINCT n, k FROM win),
placed AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN sizes)
),
hit AS (SELECT p.doc_id, p.n, p.s, p.k FROM placed p JOIN keys USING (n, k)),
cover AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS pos FROM hit) GROUP BY doc_id
),
met AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT h.doc_id, w.item FROM hit h JOIN win w USING (n, k)) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN met USING (doc_id)
"""

_PLAIN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Quartiles of summaries are exact for groups of this size, so SQL's discrete quantiles are the same values.
OP5 = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, {_PLAIN_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM d)
),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + 8)) AS pos FROM win JOIN twice USING (doc_id, k)) GROUP BY doc_id
),
c AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
),
m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_symbols / greatest(n_words, 1) AS a, n_dup_lines / greatest(n_lines, 1) AS b,
    word_chars / greatest(n_words, 1) AS e, n_repeat_words / greatest(n_words, 1) AS f
  FROM c
),
g AS (SELECT * FROM m WHERE NOT base_failed),
q1 AS (SELECT lang, source, count(*) AS n, {", ".join(f"quantile_disc({x}, [0.1, 0.5, 0.9]) AS {x}q" for x in "abef")} FROM g GROUP BY ALL),
q2 AS (SELECT lang, count(*) AS n, {", ".join(f"quantile_disc({x}, [0.1, 0.5, 0.9]) AS {x}q" for x in "abef")} FROM g GROUP BY ALL),
q3 AS (SELECT {", ".join(f"quantile_disc({x}, [0.1, 0.5, 0.9]) AS {x}q" for x in "abef")} FROM g),
lim AS (
  SELECT q1.lang, q1.source, {", ".join(f"CASE WHEN q1.n >= 200 THEN q1.{x}q WHEN q2.n >= 200 THEN q2.{x}q ELSE q3.{x}q END AS {x}q" for x in "abef")}
  FROM q1 JOIN q2 ON q1.lang IS NOT DISTINCT FROM q2.lang CROSS JOIN q3
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(
    a <= aq[3] + 3.0 * (aq[3] - aq[2]) + 1.0 / greatest(n_words, 1)
    AND b <= bq[3] + 3.0 * (bq[3] - bq[2]) + 1.0 / greatest(n_lines, 1)
    AND e <= eq[3] + 3.0 * (eq[3] - eq[2]) + 1.0 / greatest(n_words, 1)
    AND e >= eq[1] - 3.0 * (eq[2] - eq[1]) - 1.0 / greatest(n_words, 1)
    AND f <= fq[3] + 3.0 * (fq[3] - fq[2]) + 30.0 / greatest(n_words, 1), true) AS kept
FROM m LEFT JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang AND m.source IS NOT DISTINCT FROM lim.source
"""

_CONTROL = "'<|im_end|><|im_start|>assistant ok'"

OP6 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', {_CONTROL}), (-1, 1, 'assistant', {_CONTROL})
),
g AS (
  SELECT conv_id, count(*) AS n,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<x\1|', 'g')) + length('<|im_start|><|im_end|>') + 2) AS f
  FROM t GROUP BY conv_id
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n AS BIGINT) AS n_turns, sha256(told) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars,
  false AS rewrites_history
FROM g
"""

OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
),
s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s
  FROM w
),
cls AS (SELECT s, min(doc_id) AS c FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT c, len(s) AS n, unnest(s) AS g FROM cls),
p AS (
  SELECT x.c AS a, y.c AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS m
  FROM e x JOIN e y ON x.g = y.g AND x.c < y.c AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY 1, 2
),
l AS (SELECT a, b FROM p WHERE 100 * m >= 80 * (na + nb - m)),
sym AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(c, t) AS (SELECT c, c FROM cls UNION SELECT r.c, sym.b FROM r JOIN sym ON r.t = sym.a),
comp AS (SELECT c, min(t) AS k FROM r GROUP BY c)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k, s.doc_id) AS component_id,
  s.doc_id = coalesce(k, s.doc_id) AS kept, coalesce(cls.c, s.doc_id) AS class_id
FROM s LEFT JOIN cls ON s.s = cls.s AND len(s.s) > 0 LEFT JOIN comp ON cls.c = comp.c
"""

_LET = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_ASSIGN_11 = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""[""'']?\x20*[:=]\x20*[""'']?([A-Za-z0-9+/_.=-]+)"""
).replace('""', '"')
_KINDS_11 = (
    ("assign", _ASSIGN_11, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("run", "[A-Za-z0-9+/_-]+={0,2}", 0, 20),
)


def _matches_11(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return rf"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, m, list_sum(list_transform(g[:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(ms[:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT rid, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS ms,
          unnest(regexp_extract_all(t, '{pattern}')) AS m,
          unnest(regexp_extract_all(t, '{pattern}', {group})) AS v, unnest(range(1, len(regexp_extract_all(t, '{pattern}')) + 1)) AS i
        FROM d WHERE regexp_matches(t, '{pattern}')) WHERE length({"rtrim(v, '=')" if kind == "run" else "v"}) >= {least}"""


_Z = "(1.0 / (1.0 + 0.3275911 * (abs({z}) / sqrt(2.0))))"
_P = (
    "greatest(1e-12, least(1.0, {t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429))))"
    " * exp(-({z}) * ({z}) / 2.0)))"
)


def _p_11(z: str) -> str:
    return _P.format(z=z, t=_Z.format(z=z))


OP11 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED ({" UNION ALL ".join(_matches_11(n, *k) for n, k in enumerate(_KINDS_11))}),
base AS (SELECT rid, rank, kind, start, start + length(m) AS fin FROM found WHERE kind <> 'run'),
run AS (
  SELECT rid, start, start + length(m) AS fin, b, enc, CASE WHEN enc = 'hex' THEN lower(b) ELSE b END AS s,
    CASE enc {" ".join(f"WHEN '{k}' THEN '{a}'" for k, a in _LET.items())} END AS alpha,
    CASE enc {" ".join(f"WHEN '{k}' THEN {3 + n}" for n, k in enumerate(_LET))} END AS rank
  FROM (
    SELECT *, CASE
      WHEN regexp_full_match(b, '[0-9a-f]+|[0-9A-F]+') AND dig AND (low OR upp) THEN 'hex'
      WHEN regexp_full_match(b, '[A-Z2-7]+') AND dig AND upp THEN 'base32'
      WHEN regexp_full_match(b, '[A-Za-z0-9]+') AND dig AND low AND upp THEN 'base62'
      WHEN regexp_full_match(b, '[A-Za-z0-9+/]+') AND dig AND low AND upp THEN 'base64'
      WHEN regexp_full_match(b, '[A-Za-z0-9_-]+') AND dig AND low AND upp THEN 'base64url' END AS enc
    FROM (SELECT *, regexp_matches(b, '[0-9]') AS dig, regexp_matches(b, '[a-z]') AS low, regexp_matches(b, '[A-Z]') AS upp
          FROM (SELECT *, rtrim(m, '=') AS b FROM found WHERE kind = 'run'))
  ) WHERE enc IS NOT NULL
),
coded AS (
  SELECT *, CAST(length(s) AS DOUBLE) AS n, CAST(length(alpha) AS DOUBLE) AS a,
    list_transform(string_split(s, ''), lambda c: instr(alpha, c) - 1) AS x,
    list_transform(string_split(alpha, ''), lambda c: power(length(s) - length(replace(s, c, '')), 2)) AS o
  FROM run
),
sums AS (
  SELECT *, list_sum(o) AS sq, list_sum(x) AS sx, list_sum(list_transform(x, lambda c: c * c)) AS sxx,
    list_sum(list_transform(range(1, len(x) + 1), lambda i: x[i] * x[i % len(x) + 1])) AS sxy,
    list_sum(list_transform(x, lambda c: CAST(c >= a / 2 AS INTEGER))) AS n1,
    list_sum(list_transform(range(1, len(x)), lambda i: CAST((x[i] >= a / 2) <> (x[i + 1] >= a / 2) AS INTEGER))) + 1 AS r
  FROM coded
),
z AS (
  SELECT *, (power((sq * a / n - n) / (a - 1), 1.0 / 3) - (1 - 2.0 / (9 * (a - 1)))) / sqrt(2.0 / (9 * (a - 1))) AS z1,
    2.0 * n1 * (n - n1) AS h, n * sxx - sx * sx AS v, n * sxy - sx * sx AS w
  FROM sums
),
p AS (
  SELECT *, {_p_11("z1")} AS p1,
    CASE WHEN h * (h - n) > 0 THEN {_p_11("((r - h / n - 1) / sqrt(h * (h - n) / (n * n * (n - 1))))")} ELSE 1e-12 END AS p2,
    CASE WHEN v > 0 THEN {_p_11("((w / v + 1 / (n - 1)) * (n - 1) / sqrt(n * (n - 3) / (n + 1)))")} ELSE 1e-12 END AS p3
  FROM z
),
binned AS (
  SELECT rid, start, fin, rank, enc, CAST(floor(log2(n)) AS INTEGER) AS band,
    least(199, CAST(floor(exp(-y) * (1 + y + y * y / 2) * 200 + 1e-7) AS INTEGER)) AS bin
  FROM (SELECT *, -ln(p1) - ln(p2) - ln(p3) AS y FROM p)
),
graded AS (
  SELECT enc, band, bin, sum(n) OVER (PARTITION BY enc, band ORDER BY bin DESC) AS above,
    2 * sum(CASE WHEN bin >= 100 THEN n ELSE 0 END) OVER (PARTITION BY enc, band) AS random
  FROM (SELECT enc, band, bin, count(*) AS n FROM binned GROUP BY ALL)
),
lim AS (
  SELECT enc, band, coalesce(min(bin) FILTER (bin < 100 AND above - random * (1 - bin / 200.0) <= 0.05 * above + 1e-9), 100) AS from_bin
  FROM graded GROUP BY ALL
),
added AS (
  SELECT rid, rank, 'random_' || enc AS kind, start, fin FROM binned b JOIN lim USING (enc, band)
  WHERE bin >= from_bin AND NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = b.rid AND x.start <= b.start AND b.fin <= x.fin)
),
bd AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n1, count(*) FILTER (kind = 'access') AS n2, count(*) FILTER (kind = 'hex') AS n3,
    string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) AS told
  FROM (SELECT rid, rank, kind, CAST(start AS BIGINT) AS start, CAST(fin AS BIGINT) AS fin FROM base) GROUP BY rid
),
al AS (
  SELECT rid, string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) AS spans
  FROM (SELECT rid, rank, kind, CAST(start AS BIGINT) AS start, CAST(fin AS BIGINT) AS fin
        FROM (SELECT * FROM base UNION ALL SELECT * FROM added)) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(n1, 0) AS BIGINT) AS n_assign, CAST(coalesce(n2, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n3, 0) AS BIGINT) AS n_hex, sha256(coalesce(told, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN bd USING (rid) LEFT JOIN al USING (rid)
"""

# Rebuilt conversations as lists of turns; a prefix is the list itself, so nothing is hashed.
OP12 = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
crc(i, v) AS (
  SELECT i, list_reduce([CAST(i AS BIGINT), 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) FROM range(256) r(i)
),
h AS (
  SELECT c, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: xor(a >> 8, tab[xor(a, b) % 256 + 1])), 4294967295) % 4 AS h
  FROM t CROSS JOIN (SELECT list(v ORDER BY i) AS tab FROM crc)
),
b AS (
  SELECT t.c, list_concat(coalesce(base.l[:h.h], []), t.l[h.h + 1:]) AS l
  FROM t JOIN h USING (c) LEFT JOIN t base ON base.c = t.c - t.c % 20
),
p AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM b),
n AS (
  SELECT l[:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(l) = d) AS ends
  FROM p GROUP BY 1, 2
),
kids AS (SELECT k[:d - 1] AS k, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
m AS (
  SELECT n.*, coalesce(kids.n, 0) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.k[n.d].x, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k
),
sub AS (
  SELECT k[:u] AS k, u AS d, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS u FROM m) GROUP BY ALL
)
SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
  sub.leaves AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN sub ON sub.d = m.d AND sub.k = m.k LEFT JOIN m up ON up.d = m.d - 1 AND up.k = m.k[:m.d - 1]
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(ln) AS ln FROM kept GROUP BY lang),
gn AS (SELECT lang, source, sum(n) AS gn FROM c GROUP BY ALL),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // CAST(coalesce(gn, 0) + v AS HUGEINT) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.ln + 1) // CAST(v.ln + v AS HUGEINT) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
WHERE part = 'pair' OR r <= 200
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op5_quality_rules": OP5,
    "op6_chat_formatting": OP6,
    "op8_near_duplicates": OP8,
    "op11_secret_scan": OP11,
    "op12_prefix_trie": OP12,
    "op13_source_divergence": OP13,
}
