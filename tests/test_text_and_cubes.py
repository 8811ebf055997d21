"""Predicates, lexicon pairs, cubes, shares and token tables on edge tables."""

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
from tests.conftest import SF_MID

AUTH, NEG = ["whou", "eaux"], ["ouen", "licen"]


def _docs(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet")


def test_lexicon_counts_on_fixture(spark):
    d = _docs(spark)
    got = [d.filter(f("text", AUTH, NEG)).count() for f in
           (lexicon_literal, lexicon_intended, complement_literal, complement_intended)]
    assert got == [278, 162, 302, 141]


def test_intended_pair_partitions_auth_set(spark):
    d = _docs(spark).select("doc_id", "text")
    auth = d.filter(contains_any("text", AUTH))
    neg = d.filter(lexicon_intended("text", AUTH, NEG))
    non = d.filter(complement_intended("text", AUTH, NEG))
    assert neg.join(non, "doc_id").count() == 0
    assert neg.count() + non.count() == auth.count()


def test_predicates_on_edge_rows(spark):
    rows = [(1, None), (2, "AUTHENTIC food"), (3, "authentic but dirty"), (4, "legitimate and bad"),
            (5, "legitimate, dirty cheap kitsch rude simple bad"), (6, "plain")]
    df = spark.createDataFrame(rows, "id int, text string")
    auth, neg = ["authentic", "legitimate"], ["dirty", "cheap", "kitsch", "rude", "simple", "bad"]

    def ids(pred):
        return sorted(r.id for r in df.filter(pred).collect())
    assert ids(lexicon_literal("text", auth, neg)) == [3, 4, 5]      # authentic OR (legit AND neg)
    assert ids(lexicon_intended("text", auth, neg)) == [3, 4, 5]
    assert ids(complement_literal("text", auth, neg)) == [3, 4]      # 5 has every negative word
    assert ids(complement_intended("text", auth, neg)) == []
    assert ids(ci_contains("text", "authentic")) == [2, 3]
    assert df.filter(ci_contains("text", "x")).count() == 0          # null text -> False, no error
    assert ids(variant_match("text", "authentic")) == [2, 3]


def test_cube_total_equals_row_count_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), ("b", 4)], "state string, v int")
    c = R.cube_counts(df, ["state"]).collect()
    total = [r for r in c if r.gid == 1]
    assert len(total) == 1 and total[0].n == 4 and total[0].state is None
    real_null = [r for r in c if r.gid == 0 and r.state is None]
    assert real_null[0].n == 1


def test_two_sided_ratio_zero_denominator_and_null_safe(spark):
    all_rows = spark.createDataFrame([("a",), (None,), ("b",)], "state string")
    match = spark.createDataFrame([("a",), (None,), ("c",)], "state string")
    lit = R.cube_share_two_sided(all_rows, match, "state", null_safe=False).collect()
    # state 'c' only on the matching side: all = 0 -> ratio null, no DIVIDE_BY_ZERO
    c_row = [r for r in lit if r.state_auth == "c"][0]
    assert c_row.all_lan_count == 0 and c_row.ratio is None
    safe = R.cube_share_two_sided(all_rows, match, "state", null_safe=True).collect()
    totals = [r for r in safe if r.state is None and r.state_auth is None and r.all_lan_count == 3]
    assert totals and totals[0].auth_lan_count == 3 and totals[0].ratio == 100.0


def test_cube_share_single_pass_equals_two_sided(spark):
    d = _docs(spark).select(F.nullif("lang", F.lit("de")).alias("lang"), "text")
    one = {(r.lang, r.gid): (r.all_count, r.match_count)
           for r in R.cube_share(d, ["lang"], contains_any("text", AUTH)).collect()}
    two = R.cube_share_two_sided(d, d.filter(contains_any("text", AUTH)), "lang", True).collect()
    for r in two:
        key = (r.lang, 1 if r.lang is None and r.all_lan_count == d.count() else 0)
        assert one[key] == (r.all_lan_count, r.auth_lan_count)


def test_topk_tie_break_by_token(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "token string, n long")
    assert [r.token for r in R.top_k(df, 3, "n", "token").collect()] == ["c", "a", "b"]


def test_category_counts_null_categories_and_drop(spark):
    business = spark.createDataFrame(
        [(1, "Restaurants, Mexican", "AZ", "x"), (2, None, "AZ", "y"), (3, "Restaurant supply, Soul Food", None, "z")],
        "business_id int, categories string, state string, city string")
    reviews = spark.createDataFrame([(1, "authentic and bad"), (1, "authentic"), (2, "authentic, rude"),
                                     (3, "legitimate simple")], "business_id int, text string")
    bad = E.e9_category_table(reviews, business, "intended").collect()
    got = {r.category: r.n for r in bad}
    # business 2 has null categories (dropped); "Restaurants" removed; restaurant test is case-insensitive
    assert got == {"Mexican": 1, "Restaurant supply": 1, "Soul Food": 1}


def test_set_ratio_counter_semantics(spark):
    a = spark.createDataFrame([("x", 2), ("y", 3)], "token string, n long")
    b = spark.createDataFrame([("x", 4)], "token string, n long")
    r = R.set_ratio(a, b, ["x", "y", "absent"]).first()
    assert (r.numerator, r.denominator, r.ratio) == (5, 4, 1.25)
    z = R.set_ratio(a, b.filter("false"), ["x"]).first()
    assert z.denominator == 0 and z.ratio is None
    g = {r.region: r for r in R.grouped_set_ratio(a, b, {"p": ["x"], "q": ["nothing"]}).collect()}
    assert g["q"].numerator == 0 and g["q"].ratio is None and g["p"].ratio == 0.5


def test_distinct_vs_row_counts_differ_on_fixture(spark):
    import __spark_entry__ as ENTRY
    q = ENTRY.queries()
    assert q["e4_influencer_businesses"](spark, SF_MID).count() == 64
    assert q["distinct_influencers"](spark, SF_MID).count() == 58
