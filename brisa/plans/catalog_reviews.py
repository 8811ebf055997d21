"""Registered queries: sources, predicates, joins, aggregates, sets and the
review analyses (E1-E10), each with its DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions.text import (
    ci_contains,
    complement_intended,
    complement_literal,
    contains_any,
    lexicon_intended,
    lexicon_literal,
    variant_match,
)
from brisa.operators import relational as R
from brisa.plans import reviews as E
from brisa.plans import standins as S
from brisa.plans.registry import ORACLE, register
from brisa.plans.tables import table as T
from brisa.session import scratch_path
from brisa.sources import files as FS

AUTH, NEG = S.AUTH, S.NEG
SEP = S.CATEGORY_SEP
# Stand-in parameters for the review analyses on part / documents.
CUISINES = ["small", "hot", "widget", "Soul"]
REGIONS = {"warm": ["hot", "red", "Soul"], "cool": ["cold", "blue", "new", "old"]}
MARKER, DROPPED = "Gear", "gear"

_AUTH_SQL = "(text LIKE '%whou%' OR text LIKE '%eaux%')"
_NEG_SQL = "(text LIKE '%ouen%' OR text LIKE '%licen%')"
_BUSINESS_SQL = """SELECT p_partkey AS business_id, p_name AS name, p_name AS categories,
    p_brand AS state, p_type AS city, p_partkey % 5 + 1 AS stars, p_size AS review_count FROM part"""
_REVIEWS_SQL = """SELECT doc_id AS review_id, (doc_id * 7919) % (SELECT count(*) FROM part) AS business_id, doc_id % 37 AS user_id,
    text, doc_id % 5 + 1 AS stars FROM documents"""
_INFLUENCERS_SQL = """SELECT c_custkey AS user_id FROM customer
    JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON o.o_custkey = c_custkey
    WHERE o.n > 15"""
_USER_REVIEWS_SQL = """SELECT o.o_custkey AS user_id, l.l_partkey AS business_id
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
_DOCS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


# ======================================================= S: sources / sinks
@register("scan_jsonl", _DOCS)
def scan_jsonl(spark, d):
    src = T(spark, d, "documents")
    path = scratch_path(spark, "jsonl")
    FS.write_jsonl(src, path)
    return FS.read_jsonl(spark, path, src.schema)


@register("scan_json_multiline", _DOCS)
def scan_json_multiline(spark, d):
    src = T(spark, d, "documents")
    path = scratch_path(spark, "json-array")
    FS.write_json_arrays(src, path)
    return FS.read_json_multiline(spark, path, src.schema)


@register("scan_csv_quoted", _DOCS)
def scan_csv_quoted(spark, d):
    src = T(spark, d, "documents")
    path = scratch_path(spark, "csv")
    FS.write_csv(src, path)
    return FS.read_csv(spark, path, src.schema)


_E10_SQL = f"""SELECT b.name, r.text FROM ({_REVIEWS_SQL}) r
    JOIN ({_BUSINESS_SQL}) b ON r.business_id = b.business_id
    WHERE b.state = 'Brand#2' AND regexp_matches(b.categories, 'gear|bolt') AND r.stars = 5"""


@register("write_csv_roundtrip", _E10_SQL)
def write_csv_roundtrip(spark, d):
    out = e10_good_reviews(spark, d)
    path = scratch_path(spark, "export")
    FS.write_csv(out, path)
    return FS.read_csv(spark, path, out.schema)


@register("sql_view_named_args", """SELECT doc_id, n_chars FROM documents
    WHERE lang = 'fr' AND n_chars > 1000""")
def sql_view_named_args(spark, d):
    T(spark, d, "documents").createOrReplaceTempView("brisa_documents")
    return spark.sql("SELECT doc_id, n_chars FROM brisa_documents WHERE lang = :lang AND n_chars > :min_chars",
                     args={"lang": "fr", "min_chars": 1000})


@register("inline_table", """WITH g(token, grp) AS (VALUES ('hot','warm'),('red','warm'),('Soul','warm'),
    ('cold','cool'),('blue','cool'),('new','cool'),('old','cool'))
    SELECT g.grp, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) t
    JOIN g ON g.token = t.token GROUP BY g.grp""")
def inline_table(spark, d):
    g = FS.inline_table(spark, [(t, grp) for grp, toks in REGIONS.items() for t in toks],
                        "token string, grp string")
    toks = R.explode_tokens(T(spark, d, "part"), "p_name", SEP, "token")
    return toks.join(F.broadcast(g), "token").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))


@register("tokenise_list", """SELECT p_partkey, unnest(range(0, len(string_split(p_name, ' ')))) AS pos,
    unnest(string_split(p_name, ' ')) AS token FROM part""")
def tokenise_list(spark, d):
    return FS.tokenise(T(spark, d, "part"), "p_name", SEP, keep=["p_partkey"])


@register("decode_resultset", "SELECT ts AS time, value, event_type FROM events")
def decode_resultset(spark, d):
    e = T(spark, d, "events")
    raw = e.select(F.array(F.col("ts").cast("string"), F.col("value").cast("string"),
                           F.col("event_type")).alias("values"))
    return FS.decode_resultset(raw, "values", ["time", "value", "event_type"], {"value": "double"})


@register("decode_payload", "SELECT ts AS time, value, event_type, CAST(NULL AS VARCHAR) AS missing FROM events")
def decode_payload(spark, d):
    """Events as JSON results of up to 100 rows, every other one with its columns in another order."""
    e = T(spark, d, "events").select(F.floor(F.col("event_id") / 100).alias("page"), F.col("ts").cast("string").alias("time"),
                                     F.col("value").cast("string").alias("value"), "event_type")
    orders = [["time", "value", "event_type"], ["event_type", "time", "value"]]
    names = F.when(F.col("page") % 2 == 0, F.array(*map(F.lit, orders[0]))).otherwise(F.array(*map(F.lit, orders[1])))
    row = F.when(F.col("page") % 2 == 0, F.array(*orders[0])).otherwise(F.array(*orders[1]))
    pages = e.groupBy("page").agg(F.first(names).alias("columns"), F.collect_list(row).alias("values"))
    raw = pages.select(F.to_json(F.struct("columns", "values")).alias("payload"))
    return FS.decode_payload(raw, "payload", {"time": "timestamp_ntz", "value": "double", "event_type": "string", "missing": "string"})


# ======================================================= P: predicates
@register("filter_and", "SELECT p_partkey, p_name FROM part WHERE p_size = 5 AND p_retailprice >= 950")
def filter_and(spark, d):
    return T(spark, d, "part").filter("p_size = 5 AND p_retailprice >= 950").select("p_partkey", "p_name")


@register("compare_ops", """SELECT c_custkey, c_acctbal > 5000 AS gt, c_mktsegment = 'BUILDING' AS eq,
    nullif(c_mktsegment, 'HOUSEHOLD') <> 'BUILDING' AS ne_sql,
    nullif(c_mktsegment, 'HOUSEHOLD') IS DISTINCT FROM 'BUILDING' AS ne_keep_null FROM customer""")
def compare_ops(spark, d):
    c = T(spark, d, "customer")
    seg = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))
    return c.select("c_custkey", (F.col("c_acctbal") > 5000).alias("gt"),
                    (F.col("c_mktsegment") == "BUILDING").alias("eq"),
                    (seg != "BUILDING").alias("ne_sql"),
                    (~seg.eqNullSafe("BUILDING")).alias("ne_keep_null"))


@register("in_list", "SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')")
def in_list(spark, d):
    return T(spark, d, "documents").filter(F.col("lang").isin("de", "fr")).select("doc_id", "lang")


@register("not_null_or", """SELECT doc_id, state, city FROM (SELECT doc_id, nullif(lang, 'en') AS state,
    nullif(source, 'src3') AS city FROM documents) WHERE state IS NOT NULL OR city IS NOT NULL""")
def not_null_or(spark, d):
    x = T(spark, d, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("state"),
                                         F.nullif("source", F.lit("src3")).alias("city"))
    return x.filter(F.col("state").isNotNull() | F.col("city").isNotNull())


@register("regex", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(hot|cold) ')")
def regex(spark, d):
    return T(spark, d, "part").filter(F.col("p_name").rlike("^(hot|cold) ")).select("p_partkey", "p_name")


@register("ci_contains", """SELECT doc_id, coalesce(contains(lower(CASE WHEN lang = 'en' THEN NULL ELSE text END),
    'that'), false) AS flag FROM documents""")
def ci_contains_q(spark, d):
    x = T(spark, d, "documents")
    txt = F.when(F.col("lang") == "en", F.lit(None)).otherwise(F.col("text"))
    return x.select("doc_id", ci_contains(txt, "That").alias("flag"))


@register("variant_match", r"SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|\P{L})that')")
def variant_match_q(spark, d):
    return T(spark, d, "documents").filter(variant_match("text", "that")).select("doc_id")


@register("contains_any", "SELECT doc_id FROM documents WHERE text LIKE '%whou%' OR text LIKE '%eaux%'")
def contains_any_q(spark, d):
    return T(spark, d, "documents").filter(contains_any("text", AUTH)).select("doc_id")


@register("lexicon_literal", f"SELECT doc_id FROM documents WHERE text LIKE '%whou%' OR text LIKE '%eaux%' AND {_NEG_SQL}")
def lexicon_literal_q(spark, d):
    return T(spark, d, "documents").filter(lexicon_literal("text", AUTH, NEG)).select("doc_id")


@register("lexicon_intended", f"SELECT doc_id FROM documents WHERE {_AUTH_SQL} AND {_NEG_SQL}")
def lexicon_intended_q(spark, d):
    return T(spark, d, "documents").filter(lexicon_intended("text", AUTH, NEG)).select("doc_id")


@register("complement_literal", """SELECT doc_id FROM documents WHERE text LIKE '%whou%' OR text LIKE '%eaux%'
    AND (text NOT LIKE '%ouen%' OR text NOT LIKE '%licen%')""")
def complement_literal_q(spark, d):
    return T(spark, d, "documents").filter(complement_literal("text", AUTH, NEG)).select("doc_id")


@register("complement_intended", f"SELECT doc_id FROM documents WHERE {_AUTH_SQL} AND NOT {_NEG_SQL}")
def complement_intended_q(spark, d):
    return T(spark, d, "documents").filter(complement_intended("text", AUTH, NEG)).select("doc_id")


@register("fill_zero", "SELECT c_custkey, coalesce(nullif(c_nationkey, 3), 0) AS c_nationkey FROM customer")
def fill_zero(spark, d):
    c = T(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"))
    return c.fillna(0, subset=["c_nationkey"])


@register("drop_null", """SELECT event_id, event_type, user_id FROM (SELECT event_id,
    nullif(event_type, 'view') AS event_type, nullif(user_id, 7) AS user_id FROM events)
    WHERE event_type IS NOT NULL AND user_id IS NOT NULL""")
def drop_null(spark, d):
    e = T(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"),
                                      F.nullif("user_id", F.lit(7)).alias("user_id"))
    return e.dropna(how="any")


@register("cast_rename_drop", """SELECT event_id, CAST(user_id AS VARCHAR) AS user_name, value AS Total
    FROM events""")
def cast_rename_drop(spark, d):
    e = T(spark, d, "events")
    return (e.withColumn("user_name", F.col("user_id").cast("string"))
            .withColumnRenamed("value", "Total")
            .drop("ts", "event_type", "props", "user_id"))


@register("having_count", "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def having_count(spark, d):
    return R.having_count(T(spark, d, "orders"), "o_custkey", 15)


# ======================================================= J: joins
@register("join_fact_dim", """SELECT l.l_orderkey, l.l_linenumber, p.p_name FROM lineitem l
    JOIN part p ON l.l_partkey = p.p_partkey""")
def join_fact_dim(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return li.join(T(spark, d, "part").select("p_partkey", "p_name"), "p_partkey").drop("p_partkey")


@register("semi_influencers", f"SELECT o_orderkey FROM orders WHERE o_custkey IN ({_INFLUENCERS_SQL})")
def semi_influencers(spark, d):
    inf = E.e3_influencers(S.users(spark, d), 15)
    o = T(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return o.join(inf, "user_id", "left_semi").select("o_orderkey")


@register("chain_join", f"""SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, p.p_name FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
    JOIN ({_INFLUENCERS_SQL}) i ON i.user_id = o.o_custkey""")
def chain_join(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    p = T(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    inf = E.e3_influencers(S.users(spark, d), 15).withColumnRenamed("user_id", "o_custkey")
    return li.join(o, "l_orderkey").join(p, "l_partkey").join(inf, "o_custkey") \
        .select("l_orderkey", "l_linenumber", "o_custkey", "p_name")


@register("full_outer", """SELECT a.lang, a.all_n, m.lang_m, m.match_n FROM
    (SELECT nullif(lang, 'de') AS lang, count(*) AS all_n FROM documents GROUP BY 1) a FULL OUTER JOIN
    (SELECT nullif(lang, 'de') AS lang_m, count(*) AS match_n FROM documents WHERE text LIKE '%ouen%'
     AND lang <> 'fr' GROUP BY 1) m ON a.lang = m.lang_m""")
def full_outer(spark, d):
    x = T(spark, d, "documents").select(F.nullif("lang", F.lit("de")).alias("lang"), "text",
                                         F.col("lang").alias("raw_lang"))
    a = x.groupBy("lang").agg(F.count(F.lit(1)).alias("all_n"))
    m = x.filter(F.col("text").contains("ouen") & (F.col("raw_lang") != "fr")) \
        .groupBy(F.col("lang").alias("lang_m")).agg(F.count(F.lit(1)).alias("match_n"))
    return a.join(m, a.lang == m.lang_m, "full_outer")


@register("merge_suffixed", """SELECT c.nationkey, c.n AS n_x, c.acctbal AS acctbal_x, s.n AS n_y,
    s.acctbal AS acctbal_y FROM
    (SELECT c_nationkey AS nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS acctbal FROM customer GROUP BY 1) c
    JOIN (SELECT s_nationkey AS nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS acctbal FROM supplier GROUP BY 1) s
    ON c.nationkey = s.nationkey""")
def merge_suffixed(spark, d):
    c = T(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("acctbal"))
    s = T(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("acctbal"))
    return R.merge_suffixed(c, s, ["nationkey"])


# ======================================================= A: aggregates
@register("sum_total", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def sum_total(spark, d):
    return T(spark, d, "orders").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("count_ratio", """SELECT CAST(count(*) FILTER (WHERE text LIKE '%ouen%') AS DOUBLE) * 100.0
    / CAST(count(*) AS DOUBLE) AS percent, count(*) FILTER (WHERE text LIKE '%ouen%') AS matching,
    count(*) AS total FROM documents""")
def count_ratio(spark, d):
    return R.share_percent(T(spark, d, "documents"), F.col("text").contains("ouen"))


@register("group_count", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def group_count(spark, d):
    return T(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("count"))


@register("group_count_col", """SELECT l.l_returnflag, count(o.o_orderkey) AS n_orders FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_returnflag""")
def group_count_col(spark, d):
    T(spark, d, "lineitem").createOrReplaceTempView("brisa_lineitem")
    T(spark, d, "orders").createOrReplaceTempView("brisa_orders")
    return spark.sql("""SELECT l.l_returnflag, count(o.o_orderkey) AS n_orders FROM brisa_lineitem l
        JOIN brisa_orders o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_returnflag""")


@register("regroup_sum", """SELECT CAST(sum(count) AS BIGINT) AS total FROM
    (SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1)""")
def regroup_sum(spark, d):
    g = T(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("count"))
    return g.agg(F.sum("count").alias("total"))


@register("max_value", "SELECT max(o_totalprice) AS max_price, max(o_orderdate) AS last_order FROM orders")
def max_value(spark, d):
    return T(spark, d, "orders").agg(F.max("o_totalprice").alias("max_price"),
                                     F.max("o_orderdate").alias("last_order"))


@register("cube_one", "SELECT lang, count(*) AS n, grouping_id(lang) AS gid FROM documents GROUP BY CUBE (lang)")
def cube_one(spark, d):
    return R.cube_counts(T(spark, d, "documents").select("lang"), ["lang"])


@register("cube_full", """SELECT lang, source, flag, count(*) AS n, grouping_id(lang, source, flag) AS gid
    FROM (SELECT lang, source, text LIKE '%ouen%' AS flag FROM documents) GROUP BY CUBE (lang, source, flag)""")
def cube_full(spark, d):
    x = T(spark, d, "documents").select("lang", "source", F.col("text").contains("ouen").alias("flag"))
    return R.cube_counts(x, ["lang", "source", "flag"])


@register("area_split", r"""SELECT r.r_name AS region, count(*) AS documents,
    count(*) FILTER (WHERE d.text LIKE '%whou%') AS matches FROM documents d
    JOIN nation n ON n.n_nationkey = CAST(regexp_extract(d.source, '(\d+)', 1) AS INTEGER)
    JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name""")
def area_split(spark, d):
    docs = T(spark, d, "documents").select(
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("n_nationkey"),
        F.col("text").contains("whou").alias("m"))
    # Pre-aggregate documents to one row per nation before meeting the dimension.
    per_nation = docs.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("documents"),
                                                 F.count_if("m").alias("matches"))
    geo = T(spark, d, "nation").join(T(spark, d, "region"),
                                     F.col("n_regionkey") == F.col("r_regionkey"))
    return per_nation.join(geo, "n_nationkey").groupBy(F.col("r_name").alias("region")).agg(
        F.sum("documents").alias("documents"), F.sum("matches").alias("matches"))


@register("group_ratio", """SELECT lang, count(*) AS all_count, count(*) FILTER (WHERE m) AS match_count,
    grouping_id(lang) AS gid, CAST(count(*) FILTER (WHERE m) AS DOUBLE) * 100.0
    / NULLIF(CAST(count(*) AS DOUBLE), 0) AS ratio
    FROM (SELECT lang, (text LIKE '%whou%' OR text LIKE '%eaux%') AS m FROM documents) GROUP BY CUBE (lang)""")
def group_ratio(spark, d):
    return R.cube_share(T(spark, d, "documents"), ["lang"], contains_any("text", AUTH))


@register("group_ratio_literal", """WITH d AS (SELECT nullif(lang, 'de') AS lang, text FROM documents),
    a AS (SELECT lang, count(*) AS all_lan_count FROM d GROUP BY CUBE (lang)),
    m AS (SELECT lang AS lang_auth, count(*) AS auth_lan_count FROM d
          WHERE text LIKE '%whou%' OR text LIKE '%eaux%' GROUP BY CUBE (lang))
    SELECT lang, coalesce(all_lan_count, 0) AS all_lan_count, lang_auth,
      coalesce(auth_lan_count, 0) AS auth_lan_count,
      CAST(coalesce(auth_lan_count, 0) AS DOUBLE) * 100.0
      / NULLIF(CAST(coalesce(all_lan_count, 0) AS DOUBLE), 0) AS ratio
    FROM a FULL OUTER JOIN m ON a.lang = m.lang_auth""")
def group_ratio_literal(spark, d):
    x = T(spark, d, "documents").select(F.nullif("lang", F.lit("de")).alias("lang"), "text")
    return R.cube_share_two_sided(x, x.filter(contains_any("text", AUTH)), "lang", null_safe=False)


@register("group_ratio_null_safe", """WITH d AS (SELECT nullif(lang, 'de') AS lang, text FROM documents),
    a AS (SELECT lang, count(*) AS all_lan_count, grouping_id(lang) AS g FROM d GROUP BY CUBE (lang)),
    m AS (SELECT lang AS lang_auth, count(*) AS auth_lan_count, grouping_id(lang) AS g FROM d
          WHERE text LIKE '%whou%' OR text LIKE '%eaux%' GROUP BY CUBE (lang))
    SELECT lang, coalesce(all_lan_count, 0) AS all_lan_count, lang_auth,
      coalesce(auth_lan_count, 0) AS auth_lan_count,
      CAST(coalesce(auth_lan_count, 0) AS DOUBLE) * 100.0
      / NULLIF(CAST(coalesce(all_lan_count, 0) AS DOUBLE), 0) AS ratio
    FROM a FULL OUTER JOIN m ON a.lang IS NOT DISTINCT FROM m.lang_auth AND a.g = m.g""")
def group_ratio_null_safe(spark, d):
    x = T(spark, d, "documents").select(F.nullif("lang", F.lit("de")).alias("lang"), "text")
    return R.cube_share_two_sided(x, x.filter(contains_any("text", AUTH)), "lang", null_safe=True)


# ======================================================= tokens
_TOKENS_SQL = "SELECT unnest(string_split(p_name, ' ')) AS token FROM part"


@register("token_freq", f"SELECT token, count(*) AS n FROM ({_TOKENS_SQL}) GROUP BY token")
def token_freq(spark, d):
    return R.token_freq(T(spark, d, "part"), "p_name", SEP)


@register("topk_tokens", f"SELECT token, count(*) AS n FROM ({_TOKENS_SQL}) GROUP BY token ORDER BY n DESC, token LIMIT 5")
def topk_tokens(spark, d):
    return R.top_k(R.token_freq(T(spark, d, "part"), "p_name", SEP), 5, "n", "token")


@register("set_ratio", """WITH a AS (SELECT unnest(string_split(p_name, ' ')) AS token FROM part WHERE p_size > 25),
    b AS (SELECT unnest(string_split(p_name, ' ')) AS token FROM part WHERE p_size <= 25)
    SELECT (SELECT count(*) FROM a WHERE token IN ('hot', 'red', 'Soul')) AS numerator,
           (SELECT count(*) FROM b WHERE token IN ('hot', 'red', 'Soul')) AS denominator,
           CAST((SELECT count(*) FROM a WHERE token IN ('hot', 'red', 'Soul')) AS DOUBLE)
           / NULLIF(CAST((SELECT count(*) FROM b WHERE token IN ('hot', 'red', 'Soul')) AS DOUBLE), 0) AS ratio""")
def set_ratio(spark, d):
    p = T(spark, d, "part")
    a = R.token_freq(p.filter("p_size > 25"), "p_name", SEP)
    b = R.token_freq(p.filter("p_size <= 25"), "p_name", SEP)
    return R.set_ratio(a, b, REGIONS["warm"])


@register("distinct_influencers", f"""SELECT business_id, count(DISTINCT user_id) AS count
    FROM ({_USER_REVIEWS_SQL}) r WHERE business_id IN (SELECT p_partkey FROM part)
    AND user_id IN ({_INFLUENCERS_SQL}) GROUP BY business_id HAVING count(DISTINCT user_id) > 5""")
def distinct_influencers(spark, d):
    inf = E.e3_influencers(S.users(spark, d), 15)
    return E.e4_influencer_businesses(S.user_reviews(spark, d), S.business(spark, d), inf, 5,
                                      distinct_users=True)


@register("avg_per_user", """SELECT o_custkey AS user_id, round(avg(o_totalprice), 6) AS avg_price,
    count(*) AS orders FROM orders GROUP BY o_custkey""")
def avg_per_user(spark, d):
    return T(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("avg_price"), F.count(F.lit(1)).alias("orders"))


@register("nested_token_freq", """WITH x AS (SELECT [string_split(p_name, ' '), [p_brand]] AS x,
    [[p_type], string_split(p_name, ' ')] AS y FROM part)
    SELECT 'x' AS "column", token, count(*) AS n FROM (SELECT unnest(flatten(x)) AS token FROM x) GROUP BY token
    UNION ALL
    SELECT 'y' AS "column", token, count(*) AS n FROM (SELECT unnest(flatten(y)) AS token FROM x) GROUP BY token""")
def nested_token_freq(spark, d):
    p = T(spark, d, "part").select(
        F.array(F.split("p_name", " "), F.array("p_brand")).alias("x"),
        F.array(F.array("p_type"), F.split("p_name", " ")).alias("y"))
    return R.nested_token_freq(p, ["x", "y"])


# ======================================================= O / U: sorts and sets
@register("sort_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_desc(spark, d):
    return T(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.col("c_acctbal").desc(), "c_custkey")


@register("sort_asc", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def sort_asc(spark, d):
    return T(spark, d, "supplier").select("s_suppkey", "s_acctbal").orderBy("s_acctbal", "s_suppkey")


@register("head_tail", """(SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5)
    UNION ALL (SELECT c_custkey, c_name FROM customer ORDER BY c_custkey DESC LIMIT 5)""")
def head_tail(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_name")
    return c.orderBy("c_custkey").limit(5).unionByName(c.orderBy(F.col("c_custkey").desc()).limit(5))


@register("union_distinct", """SELECT c_nationkey AS nationkey FROM customer
    UNION SELECT s_nationkey FROM supplier""")
def union_distinct(spark, d):
    c = T(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = T(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c.union(s).distinct()


@register("union_by_name", """SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS acctbal FROM customer
    UNION ALL SELECT s_suppkey AS id, NULL::VARCHAR AS name, s_acctbal AS acctbal FROM supplier""")
def union_by_name(spark, d):
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = T(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"))
    return c.unionByName(s, allowMissingColumns=True)


# ======================================================= E1-E10
@register("e1_total_reviews", "SELECT CAST(sum(p_size) AS BIGINT) AS total_reviews FROM part")
def e1_total_reviews(spark, d):
    return E.e1_total_reviews(S.business(spark, d))


@register("e2_top_rated", f"SELECT name, stars, review_count FROM ({_BUSINESS_SQL}) WHERE stars = 5 AND review_count >= 40")
def e2_top_rated(spark, d):
    return E.e2_top_rated(S.business(spark, d), 5, 40)


@register("e3_influencers", _INFLUENCERS_SQL)
def e3_influencers(spark, d):
    return E.e3_influencers(S.users(spark, d), 15)


@register("e4_influencer_businesses", f"""SELECT business_id, count(*) AS count FROM ({_USER_REVIEWS_SQL}) r
    WHERE business_id IN (SELECT p_partkey FROM part) AND user_id IN ({_INFLUENCERS_SQL})
    GROUP BY business_id HAVING count(*) > 5""")
def e4_influencer_businesses(spark, d):
    inf = E.e3_influencers(S.users(spark, d), 15)
    return E.e4_influencer_businesses(S.user_reviews(spark, d), S.business(spark, d), inf, 5)


@register("e5_users_by_stars", "SELECT c_acctbal AS average_stars, c_custkey AS user_id FROM customer")
def e5_users_by_stars(spark, d):
    return E.e5_users_by_stored_stars(S.users(spark, d))


@register("e5_recomputed_stars", f"""SELECT user_id, round(avg(stars), 6) AS average_stars, count(*) AS reviews
    FROM ({_REVIEWS_SQL}) GROUP BY user_id""")
def e5_recomputed_stars(spark, d):
    return E.e5_users_by_review_stars(S.reviews(spark, d)).withColumn(
        "average_stars", F.round("average_stars", 6))


@register("e6_word_share", """SELECT CAST(count(*) FILTER (WHERE text LIKE '%That%') AS DOUBLE) * 100.0
    / CAST(count(*) AS DOUBLE) AS percent, count(*) FILTER (WHERE text LIKE '%That%') AS matching,
    count(*) AS total FROM documents""")
def e6_word_share(spark, d):
    return E.e6_word_share(S.reviews(spark, d), "That")


_CAT_SQL = f"""SELECT r.business_id, unnest(string_split(b.categories, ' ')) AS category
    FROM ({_REVIEWS_SQL}) r JOIN ({_BUSINESS_SQL}) b ON r.business_id = b.business_id"""


@register("e7_top_categories", f"""SELECT category, count(*) AS n FROM (SELECT r.business_id,
    unnest(string_split(b.categories, ' ')) AS category FROM ({_REVIEWS_SQL}) r
    JOIN ({_BUSINESS_SQL}) b ON r.business_id = b.business_id WHERE r.text LIKE '%ouen%')
    GROUP BY category ORDER BY n DESC, category LIMIT 40""")
def e7_top_categories(spark, d):
    return E.e7_top_categories(S.reviews(spark, d), S.business(spark, d), "ouen", 40, SEP)


@register("e7_cuisine_counts", f"""SELECT category, count(*) AS n FROM (SELECT r.business_id,
    unnest(string_split(b.categories, ' ')) AS category FROM ({_REVIEWS_SQL}) r
    JOIN ({_BUSINESS_SQL}) b ON r.business_id = b.business_id WHERE r.text LIKE '%ouen%')
    WHERE category IN ('small', 'hot', 'widget', 'Soul') GROUP BY category""")
def e7_cuisine_counts(spark, d):
    return E.e7_cuisine_counts(S.reviews(spark, d), S.business(spark, d), "ouen", CUISINES, SEP)


@register("e8_place_share", f"""SELECT state, city, count(*) AS all_count,
    count(*) FILTER (WHERE m) AS match_count, grouping_id(state, city) AS gid,
    CAST(count(*) FILTER (WHERE m) AS DOUBLE) * 100.0 / NULLIF(CAST(count(*) AS DOUBLE), 0) AS ratio
    FROM (SELECT r.business_id, coalesce({_AUTH_SQL}, false) AS m FROM ({_REVIEWS_SQL}) r) r
    JOIN (SELECT business_id, state, city FROM ({_BUSINESS_SQL})
          WHERE state IS NOT NULL OR city IS NOT NULL) b ON r.business_id = b.business_id
    GROUP BY CUBE (state, city)""")
def e8_place_share(spark, d):
    return E.e8_place_share(S.reviews(spark, d), S.business(spark, d), AUTH)


@register("e8_full_cube", f"""SELECT state, city, flag, count(*) AS n, grouping_id(state, city, flag) AS gid
    FROM (SELECT b.state, b.city, coalesce({_AUTH_SQL}, false) AS flag FROM ({_REVIEWS_SQL}) r
          JOIN (SELECT business_id, state, city FROM ({_BUSINESS_SQL})
                WHERE state IS NOT NULL OR city IS NOT NULL) b ON r.business_id = b.business_id)
    GROUP BY CUBE (state, city, flag)""")
def e8_full_cube(spark, d):
    return E.e8_place_share(S.reviews(spark, d), S.business(spark, d), AUTH, flag=True)


def _e9_sql(pred: str) -> str:
    return f"""SELECT category, count(*) AS n FROM (SELECT unnest(string_split(b.categories, ' ')) AS category
        FROM ({_REVIEWS_SQL}) r JOIN ({_BUSINESS_SQL}) b ON r.business_id = b.business_id
        WHERE ({pred}) AND coalesce(contains(lower(b.categories), 'gear'), false))
        WHERE category <> 'gear' GROUP BY category"""


_LIT = f"text LIKE '%whou%' OR text LIKE '%eaux%' AND {_NEG_SQL}"
_INT = f"{_AUTH_SQL} AND {_NEG_SQL}"
_CLIT = "text LIKE '%whou%' OR text LIKE '%eaux%' AND (text NOT LIKE '%ouen%' OR text NOT LIKE '%licen%')"
_CINT = f"{_AUTH_SQL} AND NOT {_NEG_SQL}"


def _e9(kind):
    def run(spark, d):
        return E.e9_category_table(S.reviews(spark, d), S.business(spark, d), kind, AUTH, NEG,
                                   MARKER, [DROPPED], SEP)
    return run


register("e9_negative_literal", _e9_sql(_LIT))(_e9("literal"))
register("e9_negative_intended", _e9_sql(_INT))(_e9("intended"))
register("e9_nonnegative_literal", _e9_sql(_CLIT))(_e9("complement_literal"))
register("e9_nonnegative_intended", _e9_sql(_CINT))(_e9("complement_intended"))


for _kind, _pred in (("negative", _LIT), ("nonnegative", _CLIT)):
    register(f"e9_top_{_kind}", f"SELECT * FROM ({_e9_sql(_pred)}) ORDER BY n DESC, category LIMIT 40")(
        lambda spark, d, kind={"negative": "literal", "nonnegative": "complement_literal"}[_kind]: E.e9_top_categories(
            S.reviews(spark, d), S.business(spark, d), kind, 40, auth=AUTH, neg=NEG, marker="gear", drop=("gear",), sep=SEP))


def _ratio_sql(bad: str, good: str) -> str:
    return f"""WITH g(region, token) AS (VALUES ('warm','hot'),('warm','red'),('warm','Soul'),
        ('cool','cold'),('cool','blue'),('cool','new'),('cool','old')),
        bad AS ({_e9_sql(bad)}), good AS ({_e9_sql(good)})
        SELECT region, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS numerator,
               CAST(coalesce(sum(o.n), 0) AS BIGINT) AS denominator,
               CAST(coalesce(sum(b.n), 0) AS DOUBLE) / NULLIF(CAST(coalesce(sum(o.n), 0) AS DOUBLE), 0) AS ratio
        FROM g LEFT JOIN bad b ON b.category = g.token LEFT JOIN good o ON o.category = g.token
        GROUP BY region"""


@register("e9_region_ratio_literal", _ratio_sql(_LIT, _CLIT))
def e9_region_ratio_literal(spark, d):
    return E.e9_region_ratio(S.reviews(spark, d), S.business(spark, d), True, REGIONS, auth=AUTH,
                             neg=NEG, marker=MARKER, drop=[DROPPED], sep=SEP)


@register("e9_region_ratio_intended", _ratio_sql(_INT, _CINT))
def e9_region_ratio_intended(spark, d):
    return E.e9_region_ratio(S.reviews(spark, d), S.business(spark, d), False, REGIONS, auth=AUTH,
                             neg=NEG, marker=MARKER, drop=[DROPPED], sep=SEP)


@register("e10_good_reviews", _E10_SQL)
def e10_good_reviews(spark, d):
    return E.e10_good_reviews(S.reviews(spark, d), S.business(spark, d), "Brand#2", "gear|bolt", 5)


# ======================================================= P2, A2/A3, K7
@register("select_star", _DOCS)
def select_star(spark, d):
    """``SELECT *`` through a registered view (columns pruned later by Catalyst)."""
    T(spark, d, "documents").createOrReplaceTempView("brisa_reviews")
    return spark.sql("SELECT * FROM brisa_reviews")


@register("sql_count", """SELECT count(*) AS all_rows, count(*) FILTER (WHERE text LIKE '%That%') AS matching
    FROM documents""")
def sql_count(spark, d):
    """Both counts of the share in one SQL scan (instead of two count actions)."""
    T(spark, d, "documents").createOrReplaceTempView("brisa_reviews")
    return spark.sql("SELECT count(*) AS all_rows, count_if(text LIKE '%That%') AS matching FROM brisa_reviews")


@register("show_top20", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def show_top20(spark, d):
    """What ``show()`` displays: the first 20 rows of an explicit order."""
    return T(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(
        F.col("c_acctbal").desc(), "c_custkey").limit(20)


# ======================================================= A9 north/south x urban/rural
@register("area_share", f"""SELECT half, area, count(*) AS all_count, count(*) FILTER (WHERE m) AS match_count,
    grouping_id(half, area) AS gid,
    CAST(count(*) FILTER (WHERE m) AS DOUBLE) * 100.0 / NULLIF(CAST(count(*) AS DOUBLE), 0) AS ratio
    FROM (SELECT r.business_id, coalesce({_AUTH_SQL}, false) AS m FROM ({_REVIEWS_SQL}) r) r
    JOIN (SELECT p_partkey AS business_id,
                 CASE WHEN p_retailprice >= 950 THEN 'north' WHEN p_retailprice IS NOT NULL THEN 'south' END AS half,
                 CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'urban' ELSE 'rural' END AS area FROM part) b
    ON r.business_id = b.business_id GROUP BY CUBE (half, area)""")
def area_share(spark, d):
    """Stand-in: latitude <- p_retailprice (cut 950), urban cities <- types LARGE / MEDIUM."""
    return E.area_share(S.reviews(spark, d), S.business(spark, d), 950.0, ["LARGE", "MEDIUM"], AUTH)


@register("column_names", "SELECT 'documents' AS table_name, column_name FROM (DESCRIBE documents) UNION ALL "
          "SELECT 'part' AS table_name, column_name FROM (DESCRIBE part)")
def column_names(spark, d):
    """The columns of two tables, from their schemas (no row is read)."""
    rows = [(t, c) for t in ("documents", "part") for c in T(spark, d, t).columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def _job_sql() -> str:
    pick = lambda name, key, value, src: f"SELECT '{name}' AS analysis, {key} AS key, CAST({value} AS DOUBLE) AS value FROM ({src})"
    return " UNION ALL ".join([
        pick("e1_total_reviews", "NULL", "total_reviews", ORACLE["e1_total_reviews"]),
        pick("e2_top_rated", "name", "review_count", ORACLE["e2_top_rated"]),
        pick("e6_word_share", "NULL", "round(percent, 6)", ORACLE["e6_word_share"]),
        pick("e7_top_categories", "category", "n", ORACLE["e7_top_categories"]),
        pick("e8_place_share", "state", "match_count", ORACLE["e8_place_share"]),
        pick("e9_top_negative", "category", "n", ORACLE["e9_top_negative"]),
        pick("e9_region_ratio", "region", "numerator", ORACLE["e9_region_ratio_literal"])])


@register("review_job_from_files", _job_sql())
def review_job_from_files(spark, d):
    """The stand-ins written in the shapes of the original files, and the whole job run from those files."""
    from brisa.plans import jobs as J
    paths = {}
    for name, df, schema in (("review", S.reviews(spark, d), J.REVIEW), ("business", S.business(spark, d), J.BUSINESS), ("user", S.users(spark, d), J.USER)):
        paths[name] = scratch_path(spark, f"job-{name}")
        want = spark.createDataFrame([], schema).schema
        FS.write_jsonl(df.select([F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in want]), paths[name])
    out = J.review_job(spark, **paths, min_reviews=40, influencer_reviews=15, word="That", top_word="ouen", terms=AUTH, auth=AUTH, neg=NEG,
                       marker="gear", drop=("gear",), cuisines=CUISINES, groups=REGIONS, sep=SEP, state="Brand#2", cuisine="gear|bolt")
    parts = [("e1_total_reviews", F.lit(None), "total_reviews"), ("e2_top_rated", F.col("name"), "review_count"),
             ("e6_word_share", F.lit(None), F.round("percent", 6)), ("e7_top_categories", F.col("category"), "n"),
             ("e8_place_share", F.col("state"), "match_count"), ("e9_top_negative", F.col("category"), "n"), ("e9_region_ratio", F.col("region"), "numerator")]
    frames = [out[n].select(F.lit(n).alias("analysis"), key.cast("string").alias("key"), (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"))
              for n, key, v in parts]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole
