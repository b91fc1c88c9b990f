"""DuckDB SQL with the rows of the operators that SQL can express."""

from __future__ import annotations

import re
from string import ascii_lowercase, ascii_uppercase

from . import urlgraph
from .licences import NOTICE

_LOW = f"'{ascii_uppercase}', '{ascii_lowercase}'"

DECONTAMINATION = rf"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
b1 AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
b2 AS (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM b1),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM b2),
d1 AS (SELECT r, w, n FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
d2 AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d1),
d3 AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS s FROM d2),
m AS (SELECT d3.r, d3.k, d3.n, win.item FROM d3 JOIN win ON win.n = d3.n AND win.s = d3.s),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, p FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM m)) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN i ON i.r = d.r"""

INFILL = """WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
  CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM h),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, substr(text, 1, a) AS pre, substr(text, a + 1, b - a) AS mid, substr(text, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""


def mixing(repeats: float) -> str:
    """The mixture for a limit of passes; the exponent's closed form is put on the grid that the search ends on."""
    return rf"""WITH n AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
  substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')), 1, 15) AS seed,
  CAST(greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0d\x20]+'))) AS BIGINT) AS tokens FROM documents),
s AS (SELECT key, CAST(sum(tokens) AS BIGINT) AS tokens FROM n GROUP BY key),
t AS (SELECT CAST(max(tokens) AS DOUBLE) AS most, CAST(min(tokens) AS DOUBLE) AS fewest FROM s),
a AS (SELECT most, CASE WHEN most = fewest THEN 0.0 ELSE ceil(round(ceil(greatest(0.0, 1 - ln({repeats}) / ln(most / fewest)) * 16777216) / 16777216 * 1000000, 3)) / 1000000 END AS alpha FROM t),
p AS (SELECT key, tokens, pow(tokens / most, alpha) AS power, most FROM s, a),
z AS (SELECT sum(power) AS z FROM p),
aims AS (SELECT key, tokens, power / z AS weight, CAST(floor(power / z * (most * z) + 0.5) AS BIGINT) AS aim FROM p, z),
plan AS (SELECT *, aim // tokens AS blocks, aim - aim // tokens * tokens AS rest, CAST(aim AS DOUBLE) / tokens AS epochs FROM aims),
taken AS (SELECT n.*, plan.weight, plan.epochs, plan.blocks, plan.rest, unnest(generate_series(0, plan.blocks)) AS block FROM n JOIN plan ON plan.key = n.key),
placed AS (SELECT *, CAST('0x' || substr(md5(seed || ':' || CAST(block AS VARCHAR)), 1, 15) AS BIGINT) AS place FROM taken),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY key, block ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM placed)
SELECT doc_id, source, tokens AS n_tokens, CAST(block AS INTEGER) AS block, round((block + place / 1152921504606846976.0::DOUBLE) / epochs, 12) AS position,
  round(weight, 9) AS weight, round(epochs, 9) AS epochs FROM run WHERE block < blocks OR running <= rest"""


def urls(rules: list[urlgraph.Rule], steps: int = 200, damping: float = 0.85) -> str:
    """Rules by length, then as many power steps as any graph needs to settle, then what links reach beyond them."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    fits = [
        (r, f"(host = {quote(r.host)} OR ends_with(host, {quote('.' + r.host)})) AND starts_with(path, {quote(r.path)})")
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN {quote(r.text)}" for r, f in fits) + " END"
    action = "CASE " + " ".join(f"WHEN {f} THEN {quote(r.action)}" for r, f in fits) + " END"
    return rf"""WITH RECURSIVE cut AS (SELECT page_id, html, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {_LOW}) AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
ruled AS (SELECT *, {rule} AS rule, {action} AS action FROM parts),
links AS (SELECT page_id, host AS src, translate(unnest(regexp_extract_all(html, {quote(urlgraph.LINK)}, 1)), {_LOW}) AS dst FROM parts WHERE html IS NOT NULL),
dotted AS (SELECT page_id, host AS src, translate(trim(unnest(regexp_split_to_array(html, {quote(urlgraph.BREAK)})), '.-'), {_LOW}) AS dst FROM parts WHERE html IS NOT NULL),
named AS (SELECT * FROM links UNION SELECT * FROM dotted WHERE length(dst) <= {urlgraph.LONGEST} AND regexp_matches(dst, {quote(urlgraph.NAME)})),
edges AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM named WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
both_ AS (SELECT 'trust' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
steps AS (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS share FROM both_),
seeds AS (SELECT CASE action WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, CAST(count(*) AS DOUBLE) AS mass FROM ruled WHERE action IS NOT NULL AND host <> '' GROUP BY 1, 2),
r0 AS (SELECT kind, host, mass / sum(mass) OVER (PARTITION BY kind) AS rank FROM seeds),
ranks(step, kind, host, rank) AS (SELECT 0, kind, host, rank FROM r0 UNION ALL SELECT step, kind, host, sum(rank) FROM (
  SELECT q.step + 1 AS step, r0.kind, r0.host, r0.rank * {1 - damping!r} AS rank FROM r0 CROSS JOIN (SELECT DISTINCT step FROM ranks) q UNION ALL
  SELECT r.step + 1, s.kind, s.dst, r.rank * s.share * {damping!r} FROM ranks r JOIN steps s ON s.kind = r.kind AND s.src = r.host) WHERE step <= {steps} GROUP BY step, kind, host),
scores AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN rank ELSE 0.0 END) AS trust, sum(CASE WHEN kind = 'distrust' THEN rank ELSE 0.0 END) AS distrust FROM ranks WHERE step = {steps} GROUP BY host),
reach(kind, host) AS (SELECT kind, host FROM r0 UNION SELECT s.kind, s.dst FROM reach r JOIN steps s ON s.kind = r.kind AND s.src = r.host),
far AS (SELECT host FROM reach GROUP BY host HAVING max(kind) = 'distrust')
SELECT p.page_id, p.host, p.path, p.rule, coalesce(p.action, CASE WHEN coalesce(s.distrust, 0.0) > coalesce(s.trust, 0.0) * (1 + 1e-9)
    OR coalesce(s.distrust, 0.0) = 0 AND coalesce(s.trust, 0.0) = 0 AND far.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(s.trust, 0.0), 9) AS trust, round(coalesce(s.distrust, 0.0), 9) AS distrust FROM ruled p LEFT JOIN scores s ON s.host = p.host LEFT JOIN far ON far.host = p.host"""


def licences(templates: list[tuple[str, str]], texts: list[tuple[str, str]], threshold: float = 0.8, file_share: float = 0.25, text_threshold: float = 0.95, margin: float = 0.003) -> str:
    """Every window of every text against the templates whose anchors it holds, and every text against every whole licence."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = lambda rows: ", ".join(f"({k}, {quote(n)}, {quote(t)})" for k, (n, t) in enumerate(rows))
    longest = max(len([w for w in re.split(r"[^a-z0-9]+", t.lower()) if w]) for _, t in templates)
    terms = lambda x: f"regexp_extract_all(lower({x}), '[a-z0-9]+')"
    bare = lambda x: terms(f"regexp_replace(lower({x}), '{NOTICE}', ' ', 'g')")
    return rf"""WITH files AS (SELECT row_number() OVER () AS r, doc_id, source || '/' || lang || '/' || CAST(doc_id // 100 AS VARCHAR) AS dir,
  source || '/' || lang || '/' || CAST(doc_id // 100 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, coalesce(text, '') AS text FROM documents),
tpl(template, licence, text) AS (VALUES {values(templates)}),
ftl(template, licence, text) AS (VALUES {values(texts)}),
tw AS (SELECT template, licence, length, w, count(*) AS tf FROM (SELECT template, licence, CAST(len({terms('text')}) AS INTEGER) AS length, unnest({terms('text')}) AS w FROM tpl) GROUP BY ALL),
fw AS (SELECT template, licence, w, 1 + ln(count(*)) AS tf FROM (SELECT template, licence, unnest({bare('text')}) AS w FROM ftl) GROUP BY ALL),
tfs AS (SELECT r, w, 1 + ln(count(*)) AS tf FROM (SELECT r, unnest({bare('text')}) AS w FROM files) GROUP BY ALL),
df AS (SELECT w, count(*) AS n FROM (SELECT DISTINCT r, w FROM (SELECT r, unnest({terms('text')}) AS w FROM files)) GROUP BY w),
idf AS (SELECT w, ln((1 + (SELECT count(*) FROM files)) / (1.0::DOUBLE + coalesce(df.n, 0))) + 1 AS idf FROM (SELECT w FROM tw UNION SELECT w FROM fw) LEFT JOIN df USING (w)),
tv AS (SELECT *, tf * idf AS v FROM tw JOIN idf USING (w)),
tn AS (SELECT template, sqrt(sum(v * v)) AS norm FROM tv GROUP BY template),
fv AS (SELECT *, tf * idf AS v FROM fw JOIN idf USING (w)),
fn AS (SELECT template, sqrt(sum(v * v)) AS norm FROM fv GROUP BY template),
dn AS (SELECT r, sqrt(sum(power(tf * coalesce(idf, ln(1 + (SELECT count(*) FROM files)) + 1), 2))) AS norm FROM tfs LEFT JOIN idf USING (w) GROUP BY r),
whole AS (SELECT t.r, fv.licence, round(sum(t.tf * fv.idf * fv.v) / any_value(fn.norm) / any_value(dn.norm), 6) AS score FROM tfs t JOIN fv ON fv.w = t.w JOIN fn ON fn.template = fv.template JOIN dn ON dn.r = t.r GROUP BY t.r, fv.template, fv.licence),
wranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, licence DESC) AS n, lead(score) OVER (PARTITION BY r ORDER BY score DESC, licence DESC) AS next FROM whole WHERE score >= {text_threshold - margin}),
ranked AS (SELECT *, sum(v * v) OVER (PARTITION BY template) AS total, coalesce(sum(v * v) OVER (PARTITION BY template ORDER BY v DESC, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM tv),
anchors AS (SELECT * FROM ranked WHERE total - before >= {threshold} * {threshold} * total * 0.999),
cut AS (SELECT r, list_filter(list_transform(regexp_split_to_array(lower(text), '
|[.!?:;][ 	
]'), lambda p: regexp_extract_all(p, '[a-z0-9]+')), lambda p: len(p) > 0) AS parts FROM files),
begun AS (SELECT r, parts, pos, list_slice(flatten(list_slice(parts, pos, pos + {longest} - 1)), 1, {longest}) AS words, len(flatten(parts)) AS n FROM (SELECT r, parts, unnest(generate_series(1, len(parts))) AS pos FROM cut)),
held AS (SELECT r, words, n FROM begun WHERE list_has_any(words, (SELECT list(DISTINCT w) FROM anchors))),
distinct_ AS (SELECT words, row_number() OVER () AS window_ FROM (SELECT DISTINCT words FROM held)),
pairs AS (SELECT DISTINCT d.window_, a.template, a.licence, a.length, d.words FROM (SELECT window_, words, unnest(list_distinct(words)) AS w FROM distinct_) d JOIN anchors a ON a.w = d.w),
counted AS (SELECT window_, template, licence, length, w, count(*) AS tf FROM (SELECT window_, template, licence, length, unnest(list_slice(words, 1, length)) AS w FROM pairs) GROUP BY ALL),
sums AS (SELECT c.window_, c.template, c.licence, c.length, sum(coalesce(c.tf * tv.v * tv.idf / tn.norm, 0)) AS dot, sqrt(sum(power(c.tf * coalesce(idf.idf, ln(1 + (SELECT count(*) FROM files)) + 1), 2))) AS norm
  FROM counted c LEFT JOIN idf ON idf.w = c.w LEFT JOIN tv ON tv.template = c.template AND tv.w = c.w JOIN tn ON tn.template = c.template GROUP BY 1, 2, 3, 4),
good AS (SELECT window_, licence, round(dot / norm, 6) AS score, max(length) AS length FROM sums WHERE round(dot / norm, 6) >= {threshold} GROUP BY ALL),
each AS (SELECT window_, licence, max(score) AS score FROM good GROUP BY ALL),
eranked AS (SELECT *, row_number() OVER (PARTITION BY window_ ORDER BY score DESC, licence DESC) AS n, lead(score) OVER (PARTITION BY window_ ORDER BY score DESC, licence DESC) AS next FROM each),
clear AS (SELECT d.words, g.licence, g.score, g.length FROM eranked e JOIN good g ON g.window_ = e.window_ AND g.licence = e.licence AND g.score = e.score JOIN distinct_ d ON d.window_ = e.window_
  WHERE e.n = 1 AND (e.next IS NULL OR round(e.score - e.next, 6) >= {margin})),
hits AS (SELECT h.r, 0 AS whole, c.licence, c.score, least(c.length, h.n) >= {file_share} * h.n AS file FROM held h JOIN clear c ON c.words = h.words UNION ALL
  SELECT r, 1, licence, score, true FROM wranked WHERE n = 1 AND score >= {text_threshold} AND (next IS NULL OR round(score - next, 6) >= {margin})),
own AS (SELECT r, licence AS own_licence, score AS own_score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY whole DESC, score DESC, licence DESC) AS n FROM hits) WHERE n = 1),
licensed AS (SELECT dir, licence FROM (SELECT f.dir, h.licence, row_number() OVER (PARTITION BY f.dir ORDER BY h.whole DESC, h.score DESC, h.licence DESC) AS n FROM hits h JOIN files f ON f.r = h.r WHERE h.file) WHERE n = 1),
above AS (SELECT d.dir, l.licence, l.dir AS from_dir, row_number() OVER (PARTITION BY d.dir ORDER BY length(l.dir) DESC) AS n FROM (SELECT DISTINCT dir FROM files) d
  JOIN licensed l ON d.dir = l.dir OR starts_with(d.dir, l.dir || '/'))
SELECT f.doc_id, f.path, own.own_licence, own.own_score, coalesce(own.own_licence, a.licence) AS licence, CASE WHEN own.own_licence IS NOT NULL THEN 'own'
  WHEN a.licence IS NOT NULL THEN 'inherited' END AS origin, CASE WHEN own.own_licence IS NULL THEN a.from_dir END AS from_dir
FROM files f LEFT JOIN own ON own.r = f.r LEFT JOIN above a ON a.dir = f.dir AND a.n = 1"""
