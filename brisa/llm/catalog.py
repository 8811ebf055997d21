"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import chosen_path, collocations, context_tree, licences, lsh_forest, mixing, nn_descent, ordinal, phrase_index, secrets, toxicity, url_rules, whitening
from brisa.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op5_secret_scan(spark, sf_dir):
    return secrets.report(documents(spark, sf_dir))


ORACLE["op1_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         greatest(0.05, coalesce(1 - 3 * (length(text) - length(regexp_replace(text, '[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]', '', 'g')))
           / nullif(length(text), 0)::DOUBLE, 0.05)) AS w,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s),
r AS (SELECT *, 3.0::DOUBLE * source_size AS most, 3.0::DOUBLE * source_size / weight AS level FROM w),
l AS (SELECT max((total - c) / (tw - cw)) AS fill FROM (
  SELECT sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS tw,
         coalesce(sum(most) OVER b, 0) AS c, coalesce(sum(weight) OVER b, 0) AS cw
  FROM r WINDOW b AS (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
g AS (SELECT source, source_size, least(most, fill * weight) AS target FROM r, l),
e AS (SELECT *, coalesce(least(3, floor(target / nullif(source_size, 0))), 0) AS epochs FROM g),
o0 AS (SELECT row_number() OVER () AS rid, doc_id, d.source, size, source_size, target, epochs, target - epochs * source_size AS rest, -ln(u) / w AS k, 0 AS x
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
""" + "".join(f"""o{i} AS (SELECT * EXCLUDE (x, l, s, f), CASE WHEN x = 1 OR (f AND s + size <= l) THEN 1 ELSE 0 END AS x FROM (
      SELECT *, coalesce(sum(size) FILTER (f) OVER (PARTITION BY source ORDER BY k, doc_id NULLS LAST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM (
      SELECT *, x = 0 AND size > 0 AND size <= l AS f FROM (
      SELECT *, rest - coalesce(sum(size * x) OVER (PARTITION BY source), 0) AS l FROM o{i - 1})))),
""" for i in (1, 2, 3)) + r"""o4 AS (SELECT * EXCLUDE (l, q, x), CASE WHEN q = 1 THEN 1 ELSE x END AS x FROM (
  SELECT *, CASE WHEN x = 0 AND size > l AND size < 2 * l THEN row_number() OVER (PARTITION BY source, x = 0 AND size > l AND size < 2 * l
    ORDER BY size, k, doc_id NULLS LAST) END AS q FROM (SELECT *, rest - coalesce(sum(size * x) OVER (PARTITION BY source), 0) AS l FROM o3)))
SELECT doc_id, source, size, source_size, target, (size * (epochs + x))::BIGINT AS taken FROM o4
"""


def _duck_spans(kind: str, pattern: str, group: int, keep: str) -> str:
    """Spans of one pattern: offsets from the lengths of gaps and matches."""
    p = pattern.replace("'", "''")
    return (f"SELECT rid, '{kind}' AS kind, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s, "
            f"ms[i] AS m, parts[i] AS part FROM (SELECT rid, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS ms, "
            f"regexp_extract_all(t, '{p}', {group}) AS parts, unnest(range(1, len(regexp_extract_all(t, '{p}')) + 1)) AS i FROM d) WHERE {keep}")


# the allow-list in its own words: numbers, UUIDs, words; windows that hold a placeholder do not count
_ALLOWED = r"""regexp_matches(m, '^[0-9]+([-_/+][0-9]+)*$') OR regexp_matches(lower(m), '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$') OR
  (regexp_matches(m, '^[A-Za-z/_+-]+$') AND regexp_matches(m, '[A-Za-z]')
  AND length(regexp_replace(m, '[^A-Za-z]', '', 'g')) >= 3 * len(list_filter(string_split_regex(regexp_replace(m, '([a-z])([A-Z])', '\1-\2', 'g'), '[-_/+]'), lambda p: p <> ''))
  AND len(list_filter(string_split_regex(regexp_replace(m, '([a-z])([A-Z])', '\1-\2', 'g'), '[-_/+]'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^[A-Z]?[a-z]{1,15}$') AND NOT regexp_matches(p, '^[A-Z]{1,15}$') AND NOT (regexp_matches(p, '^([A-Z]?[a-z]+|[A-Z]+)$')
      AND NOT regexp_matches(regexp_replace(lower(p), 'sch|ch|ck|ph|th|st|ng|ff|ll|mm|nn|ss|tt', 'x', 'g'), '[bcdfghjklmnpqrstvwxz]{6}')
      AND length(regexp_replace(regexp_replace(lower(p), 'sch|ch|ck|ph|th|st|ng|ff|ll|mm|nn|ss|tt', 'x', 'g'), '[^aeiouy]', '', 'g'))
        >= CAST(0.3 AS DOUBLE) * length(regexp_replace(lower(p), 'sch|ch|ck|ph|th|st|ng|ff|ll|mm|nn|ss|tt', 'x', 'g'))))) = 0)"""
_PLACEHOLDERS = "regexp_matches(lower(w), 'example|sample|dummy|placeholder|xxxx|0123456789')"
ORACLE["op5_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({' UNION ALL '.join(_duck_spans(k, p, g, f'length(part) >= {n}') for k, p, n, g in secrets.BASE)}),
cand AS (SELECT * FROM ({_duck_spans('c', secrets.CANDIDATE, 0, 'true')}) WHERE NOT ({_ALLOWED})),
win AS (SELECT rid, s, m, i, CASE WHEN regexp_matches(m, '^[0-9a-fA-F]+$') THEN 1 ELSE 0 END AS h, substr(m, i::BIGINT, 16) AS w
        FROM (SELECT *, unnest(range(1, length(m) - 14)) AS i FROM cand) WHERE NOT {_PLACEHOLDERS}),
chars AS (SELECT rid, s, m, i, h, c, count(*) AS n FROM (SELECT *, unnest(string_split(w, '')) AS c FROM win) GROUP BY ALL),
hot AS (SELECT rid, s, m, i, h FROM chars GROUP BY rid, s, m, i, h
        HAVING -sum(n / 16.0 * log2(n / 16.0)) >= CASE WHEN h = 1 THEN 3.0 ELSE 3.5 END - 1e-9),
more AS (SELECT rid, CASE WHEN h = 1 THEN 'entropy_hex' ELSE 'entropy_mixed' END AS kind, s + min(i) - 1 AS s, s + max(i) + 15 AS e
         FROM hot GROUP BY rid, hot.s, m, h),
allspans AS (SELECT rid, kind, s::BIGINT AS s, (s + length(m))::BIGINT AS e, list_position(['assign', 'access', 'hex'], kind) AS o FROM base
  UNION ALL SELECT rid, kind, s::BIGINT, e::BIGINT, CASE WHEN kind = 'entropy_hex' THEN 4 ELSE 5 END FROM more),
agg AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (o > 3) AS n_entropy,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o <= 3) AS b,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS a FROM allspans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans, coalesce(n_entropy, 0)::BIGINT AS n_entropy
FROM d LEFT JOIN agg USING (rid)
"""


@query
def op7_phrase_decontamination(spark, sf_dir):
    return phrase_index.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE["op7_phrase_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, coalesce(regexp_extract_all(
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p, least(len(w), 10) AS n
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT rid, item, i, dw.n FROM dw JOIN win USING (p, n)),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM occ) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid),
wt AS (SELECT p, list_distinct(string_split(p, ' ')) AS terms FROM (SELECT DISTINCT p FROM win)),
cand AS (SELECT rid, p FROM (SELECT DISTINCT rid, unnest(w) AS t FROM d) JOIN (SELECT p, len(terms) AS k, unnest(terms) AS t FROM wt) USING (t)
         GROUP BY rid, p, k HAVING count(*) = k),
near AS (SELECT rid, count(DISTINCT item) AS n_near FROM (
  SELECT DISTINCT rid, p FROM (SELECT rid, p, w, terms, unnest(range(1, greatest(len(w) - 13, 2))) AS s FROM cand JOIN d USING (rid) JOIN wt USING (p))
  WHERE list_has_all(w[s:s + 14], terms)) JOIN win USING (p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid) LEFT JOIN near USING (rid)
"""


@query
def op4_quality_grades(spark, sf_dir):
    return ordinal.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op6_shingle_jaccard_join(spark, sf_dir):
    return chosen_path.join(documents(spark, sf_dir))


ORACLE["op6_shingle_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS t
      FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sets AS (SELECT rid, md5(string_agg(t, '|' ORDER BY t)) AS k, count(*) AS n FROM s GROUP BY rid),
reps AS (SELECT k, min(rid) AS rid, any_value(n) AS n FROM sets GROUP BY k),
rs AS (SELECT rid, t FROM s SEMI JOIN reps USING (rid)),
both_in AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM rs x JOIN rs y ON x.t = y.t AND x.rid < y.rid GROUP BY 1, 2),
near AS (SELECT a, b FROM both_in JOIN reps p ON p.rid = a JOIN reps q ON q.rid = b WHERE 5 * c >= 4 * (p.n + q.n - c)),
sym AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near UNION ALL SELECT rid, rid FROM reps),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
root AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a),
m AS (SELECT d.rid, doc_id, r.rid AS rep FROM d JOIN sets USING (rid) JOIN reps r USING (k)),
copies AS (SELECT rep, count(*) AS n FROM m GROUP BY rep),
cls AS (SELECT root, min(doc_id) AS class_id FROM m JOIN root USING (rep) GROUP BY root),
lk AS (SELECT sym.a AS rep, sum(n) - 1 AS n_links FROM sym JOIN copies ON copies.rep = sym.b GROUP BY sym.a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(lk.n_links, 0)::BIGINT AS n_links, coalesce(copies.n - 1, 0)::BIGINT AS n_copies
FROM d LEFT JOIN m USING (rid) LEFT JOIN root ON root.rep = m.rep LEFT JOIN cls USING (root) LEFT JOIN lk ON lk.rep = m.rep LEFT JOIN copies ON copies.rep = m.rep
"""


@query
def op2_context_tree_score(spark, sf_dir):
    return context_tree.report(documents(spark, sf_dir))


@query
def op10_nn_descent(spark, sf_dir):
    return nn_descent.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@query
def op8_url_rules(spark, sf_dir):
    return url_rules.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _duck_rules() -> str:
    """CASE arms of the rule table, longest rule first."""
    arms = sorted(url_rules.RULES, key=lambda r: (len(r[0] + r[1]), r), reverse=True)
    fits = "WHEN (host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}') THEN "
    return ("CASE " + " ".join(fits.format(h, p) + f"'{h}{p}'" for h, p, _ in arms) + " END AS rule, CASE "
            + " ".join(fits.format(h, p) + f"'{v}'" for h, p, v in arms) + " END AS v")


ORACLE["op8_url_rules"] = r"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
s AS (SELECT rid, page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(r, '^[^?#]*\?([^#]*)', 1) AS q FROM u),
t AS (SELECT rid, page_id, host, path, """ + _duck_rules() + r""", list_sort(list_distinct(list_concat(list_concat(
        list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
        list_transform(list_filter(string_split_regex(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> ''),
                       lambda x: 'p:' || regexp_replace(x, '^[0-9]+$', '#'))),
        list_transform(list_filter(string_split_regex(q, '[&=]'), lambda x, i: i % 2 = 1 AND x <> ''), lambda x: 'q:' || x)))) AS tokens FROM s),
lab AS (SELECT rid, tokens, v FROM t WHERE rule IS NOT NULL AND len(tokens) > 0),
need AS (SELECT ceil(0.005 * count(*)) AS least, count(*) AS n FROM lab),
it AS (SELECT rid, v, unnest(tokens) AS a FROM lab),
ante AS (SELECT [a] AS x, rid, v FROM it UNION ALL SELECT [i.a, j.a], i.rid, i.v FROM it i JOIN it j ON i.rid = j.rid AND i.a < j.a
  UNION ALL SELECT [i.a, j.a, k.a], i.rid, i.v FROM it i JOIN it j ON i.rid = j.rid AND i.a < j.a JOIN it k ON k.rid = i.rid AND j.a < k.a),
both_n AS (SELECT x, v, count(*) AS c FROM ante GROUP BY x, v), one_n AS (SELECT x, count(*) AS c FROM ante GROUP BY x),
ru AS (SELECT x, v, b.c::DOUBLE / o.c AS conf, b.c::DOUBLE / n AS sup FROM both_n b JOIN one_n o USING (x), need WHERE b.c >= least AND b.c::DOUBLE / o.c >= 0.6),
kept AS (SELECT * FROM ru s WHERE NOT EXISTS (SELECT 1 FROM ru g WHERE g.v = s.v AND len(g.x) < len(s.x) AND g.conf >= s.conf AND list_has_all(s.x, g.x))),
best AS (SELECT rid, max(struct_pack(c := conf, s := sup, x := array_to_string(x, ' '), v := kept.v)) AS b
         FROM t JOIN kept ON list_has_all(tokens, x) WHERE rule IS NULL GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(t.v, b.v, 'allow') AS verdict, CASE WHEN rule IS NULL THEN b.x END AS mined_rule FROM t LEFT JOIN best USING (rid)
"""


@query
def op3_licence_digests(spark, sf_dir):
    return licences.scan(documents(spark, sf_dir), licences.known(spark))


def _duck_licences() -> str:
    """Canonical form in SQL: lines, claims dropped, spaces, spellings."""
    marks = "".join(licences.TYPOGRAPHIC)
    same = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in licences.SAME.items()) + "}"
    words = (f"list_transform(list_filter(string_split(regexp_replace(translate(l, '{marks}', '{' ' * len(marks)}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]', ' ', 'g'), ' '), "
             f"lambda w: w <> ''), lambda w: coalesce({same}[w], w))")
    titles = "[" + ", ".join(f"'{t}'" for t in licences.TITLES) + "]"
    lines = ("list_filter(string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)), "
             "lambda l: NOT regexp_matches(l, '^[\\x20\\x09\\x0B-\\x0D#*/;!<-]*(copyright|\\(c\\)|\u00a9|all rights reserved)') "
             f"OR regexp_matches(l, '^[\\x20\\x09\\x0B-\\x0D#*/;!<-]*copyright([a-z]|[\\x20\\x09]+({'|'.join(licences.NO_CLAIM)})([^a-z]|$))'))")
    return f"list_filter(list_transform({lines}, lambda l: array_to_string({words}, ' ')), lambda c: c <> '' AND NOT list_contains({titles}, c))"


ORACLE["op3_licence_digests"] = f"""
WITH k(name, text) AS (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licences.KNOWN)}),
kd AS (SELECT digest, min(name) AS name FROM (SELECT sha256(array_to_string({_duck_licences()}, ' ')) AS digest, name FROM k UNION ALL
       SELECT digest, name FROM (VALUES {", ".join(f"('{n}', '{h}')" for n, h in licences.DIGESTS)}) g(name, digest)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_duck_licences()} AS lines FROM documents),
w AS (SELECT rid, doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM d),
n AS (SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM (SELECT rid, sha256(l) AS digest FROM (SELECT rid, unnest(lines) AS l FROM d)) JOIN kd USING (digest) GROUP BY rid)
SELECT doc_id, digest, name AS licence, coalesce(notices, '') AS notices FROM w LEFT JOIN kd USING (digest) LEFT JOIN n USING (rid)
"""


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_lsh_forest(spark, sf_dir):
    return lsh_forest.cluster(documents(spark, sf_dir))


ORACLE["op13_lsh_forest"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + least(len(w), 2) - 1], ' ') AS t
      FROM (SELECT rid, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
sets AS (SELECT rid, md5(string_agg(t, '|' ORDER BY t)) AS k, count(*) AS n FROM s GROUP BY rid),
reps AS (SELECT k, min(rid) AS rid, any_value(n) AS n FROM sets GROUP BY k),
rs AS (SELECT rid, t, n FROM s JOIN reps USING (rid)),
near AS (SELECT x.rid AS a, y.rid AS b FROM rs x JOIN rs y ON x.t = y.t AND x.rid < y.rid AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
         GROUP BY x.rid, y.rid, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
sym AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near UNION ALL SELECT rid, rid FROM reps),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
root AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a),
m AS (SELECT sets.rid, sets.n, root FROM sets JOIN reps r USING (k) JOIN root ON root.rep = r.rid),
cls AS (SELECT root, min(doc_id) AS component_id FROM m JOIN d USING (rid) GROUP BY root)
SELECT d.doc_id, coalesce(m.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id IS NOT DISTINCT FROM coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN m USING (rid) LEFT JOIN cls USING (root)
"""


@query
def op12_collocations(spark, sf_dir):
    return collocations.mine(documents(spark, sf_dir))


ORACLE["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 30),
cut AS (SELECT *, array_to_string(w[1:i], ' ') AS lp, array_to_string(w[i + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS i FROM cand)),
sc AS (SELECT cut.lang, cut.phrase, cut.k, cut.a, i, x.c AS l, y.c AS r, (2000000::HUGEINT * cut.a) // (x.c + y.c) AS score
       FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cand c WHERE c.lang = b.lang AND c.k > b.k
         AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 80 * b.a)),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM top JOIN n USING (lang) WHERE rank <= 2000
"""
