"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from millrace.llm import credentials, decontam, divergence, licenses, linededup, quality

#: Fixed value: the white space of the text contracts, as a RE2 class.
W = r"[\x20\x09-\x0D]"

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{W}+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i:i + {quality.WINDOW - 1}] AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + {quality.WINDOW})) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
sized AS (SELECT doc_id, pos, line, length(regexp_replace(line, '{W}+', '', 'g')) AS size,
                 len(list_filter(regexp_split_to_array(line, '{W}+'), lambda x: x <> '')) AS n FROM lines),
flat AS (SELECT *, size BETWEEN 1 AND {quality.MENU_CHARS} AND n <= {quality.MENU_WORDS} AND NOT regexp_matches(line, '[{quality.ENDS}]{W}*$') AS short FROM sized),
island AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, short ORDER BY pos) AS run FROM flat),
menus AS (SELECT *, short AND count(*) OVER (PARTITION BY doc_id, short, run) >= {quality.MENU_LINES} AS menu FROM island),
judged AS (SELECT doc_id, line, size, menu
   OR length(regexp_replace(line, '[^{quality.SEPARATORS}]', '', 'g')) * 5 >= greatest(n, 10)
   OR length(regexp_replace(line, '[^#*$%&|<>{{}}\\^~=_]', '', 'g')) * 100 > size * {quality.MAX_SYMBOL_PERCENT}
   OR (length(line) - length(replace(line, '!!', ''))) / 2 * 5 >= greatest(n, 10)
   OR length(regexp_replace(line, '\P{{L}}', '', 'g')) * 100 < size * 40
   OR regexp_matches(line, '(\.\.\.|…){W}*$')
   OR (n >= {quality.UNMARKED_WORDS} AND NOT regexp_matches(line, '[{quality.SENTENCE}]'))
   OR regexp_matches(lower(line), '{"|".join(quality.BOILERPLATE).replace("'", "''")}') AS bad FROM menus),
agg AS (SELECT doc_id, sum(size)::BIGINT AS word_chars,
               (count(*) FILTER (size > 0) - count(DISTINCT line) FILTER (size > 0))::BIGINT AS n_dup_lines,
               coalesce(sum(size) FILTER (bad), 0)::BIGINT AS lost_chars,
               (count(*) FILTER (bad AND size > 0))::BIGINT AS n_failed_lines FROM judged GROUP BY doc_id),
f AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_failed_lines, lost_chars
      FROM w JOIN agg USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND lost_chars * 100 <= word_chars * {quality.MAX_LOST_PERCENT} AS kept FROM b
"""

#: Stripping white space and folding A-Z, as the line contract states it.
KEY = r"translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, {KEY} AS key FROM lines),
common AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {linededup.MIN_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {linededup.MIN_DOCS}),
marked AS (SELECT k.*, c.first IS NOT NULL AND k.doc_id > c.first AS dropped FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2 = rf"""
WITH folded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
grams AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS k
          FROM (SELECT item_id, ws, least(len(ws), {decontam.WINDOW}) AS size, unnest(range(1, len(ws) - least(len(ws), {decontam.WINDOW}) + 2)) AS i
                FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
win AS (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS k
        FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM folded, sizes)),
found AS (SELECT doc_id, win.size, i, item_id FROM win JOIN grams ON win.size = grams.size AND win.k = grams.k),
hit AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM folded LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM (SELECT * FROM s SEMI JOIN shared USING (k)) a JOIN (SELECT * FROM s SEMI JOIN shared USING (k)) b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
paths AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, paths.b FROM reach r JOIN paths ON r.other = paths.a),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """One kind's spans: gaps and matches alternate, so running sums of their lengths are positions."""
    p = pattern.replace("(?<![A-Za-z0-9+/_=-])", "").replace("{20,}+", "{20,}").replace("'", "''")
    test = "AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT regexp_full_match(hit, '[0-9a-f]{24,}')" if kind == "secret" else ""
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, stop - length(hit) AS start, stop FROM (
SELECT doc_id, hit, part, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM (
SELECT doc_id, unnest(h) AS hit, unnest(m) AS part, unnest(g[1:len(h)]) AS gap, unnest(range(len(h))) AS ord FROM (
SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS h, regexp_extract_all(t, '{p}', {group}) AS m, regexp_split_to_array(t, '{p}') AS g FROM d))) WHERE length(part) >= {least} {test}"""


_ROLES = "CASE kind WHEN 'assign' THEN 'secret' WHEN 'hex' THEN 'secret' WHEN 'secret' THEN 'secret' WHEN 'access' THEN 'identifier' WHEN 'identifier' THEN 'identifier' ELSE 'endpoint' END"
_KINDS = " UNION ALL ".join(_kind(i, *k) for i, k in enumerate(credentials.BASE + credentials.WEAK))

OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_KINDS}),
roles AS (SELECT *, {_ROLES} AS role FROM spans),
linked AS (SELECT DISTINCT a.doc_id, a.rank, a.kind, a.start, a.stop FROM roles a JOIN roles b ON a.doc_id = b.doc_id AND b.start <= a.stop + {credentials.WINDOW} AND b.stop >= a.start - {credentials.WINDOW}
           WHERE a.rank >= {len(credentials.BASE)} AND CASE a.role WHEN 'secret' THEN b.role IN ('identifier', 'endpoint') ELSE b.role = 'secret' END),
every AS (SELECT doc_id, rank, kind, start, stop FROM roles WHERE rank < {len(credentials.BASE)} UNION ALL SELECT * FROM linked),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
      string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(credentials.BASE)}) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
      FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""

_QUOTED = ", ".join(f"({i}, '{label}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
_WORDS = r"""regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_PHRASES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES)

OP12 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t, {_WORDS.format("text")} AS ws FROM documents),
base AS (SELECT rid, label, i - 1 AS place FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) x, (VALUES {_PHRASES}) p(phrase, label)
         WHERE array_to_string(ws[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
tmpl AS (SELECT tid, label, {_WORDS.format("t")} AS ws FROM (VALUES {_QUOTED}) v(tid, label, t)),
tp AS (SELECT DISTINCT tid, label, ws[i] || ' ' || ws[i + 1] AS k FROM (SELECT tid, label, ws, unnest(range(1, len(ws))) AS i FROM tmpl)),
size AS (SELECT tid, count(*) AS n FROM tp GROUP BY tid),
blocks AS (SELECT rid, bno, {_WORDS.format("b")} AS ws FROM (SELECT rid, unnest(bs) AS b, generate_subscripts(bs, 1) AS bno
           FROM (SELECT rid, regexp_split_to_array(t, '\n[\x09-\x0D\x20]*\n') AS bs FROM d))),
bp AS (SELECT DISTINCT rid, bno, ws[i] || ' ' || ws[i + 1] AS k FROM (SELECT rid, bno, ws, unnest(range(1, len(ws))) AS i FROM blocks)),
found AS (SELECT rid, bno, label, count(*) / n AS c FROM bp JOIN tp USING (k) JOIN size USING (tid) GROUP BY rid, bno, tid, label, n HAVING count(*) * 100 >= n * {licenses.PERCENT}),
b AS (SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM base GROUP BY rid),
names AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels, string_agg(label, ',' ORDER BY label) FILTER (isbase) AS base_labels
          FROM (SELECT rid, label, max(isbase) AS isbase FROM (SELECT rid, label, true AS isbase FROM base UNION ALL SELECT rid, label, false FROM found) GROUP BY ALL) GROUP BY rid),
best AS (SELECT rid, max(c) AS c FROM found GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN names USING (rid) LEFT JOIN best USING (rid)
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}),
grp AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(s.c, 0)::HUGEINT AS c FROM grp g JOIN kept k USING (lang) LEFT JOIN seen s USING (lang, source, term)),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM dense GROUP BY ALL),
p AS (SELECT lang, source, term, c, 1 + ({divergence.SCALE} * (c + 2)) // (n + 2 * v) AS p FROM dense JOIN n USING (lang, source) JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + ({divergence.SCALE} * (sum(c)::HUGEINT + 2)) // (max(total) + 2 * max(v)) AS q
      FROM dense JOIN (SELECT lang, sum(n)::HUGEINT AS total FROM n GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
                     FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p.p > q.q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

ORACLES = {
    "op12_license_scan": OP12,
    "op13_source_divergence": OP13,
    "op1_minhash_near_dedup": OP1,
    "op8_secret_scan": OP8,
    "op2_decontamination": OP2,
    "op5_line_dedup": OP5,
    "op10_quality_rules": OP10,
}
