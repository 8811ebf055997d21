"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import hashlib
import math
import zlib

from pyspark.sql import functions as F

from brisa.llm import chosen_path, context_tree, licences, mixing, nn_descent, ordinal, phrase_index, secrets, toxicity, url_rules
from tests.llm.conftest import EDGE

N = len(EDGE)
NOTHING = hashlib.sha256(b"").hexdigest()


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_mix(edge, empty):
    got = by_id(mixing.mix(edge))
    assert sum(map(len, got.values())) == N
    assert {got[i][0].size for i in (1, 2, 3)} == {0} and {got[i][0].taken for i in (1, 2, 3)} == {0}
    assert got[5][0].size == 60_000 and got[11][0].size == 4 and got[9][0].size == 1
    assert {r.source for i in (3, 8) for r in got[i]} == {None}
    for rs in got.values():
        for r in rs:
            assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
    assert len(got[6]) == 2
    assert mixing.mix(empty).count() == 0


def test_mix_hot_repeated_rows(make):
    rows = [(1, "a b c d", "en", "hot", 1)] * 300 + [(i, "x y z", "en", f"s{i % 3}", 1) for i in range(2, 302)]
    got = mixing.mix(make(rows)).collect()
    again = mixing.mix(make(rows).repartition(7)).collect()
    key = lambda r: (r.doc_id, r.source, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert abs(mine[0].target - sum(r.taken for r in mine)) <= 2


def test_context_tree(edge, empty):
    got = by_id(context_tree.report(edge))
    assert sum(map(len, got.values())) == N
    assert {got[i][0].n_tokens for i in (1, 2, 3)} == {1} and {got[i][0].n_bytes for i in (1, 2, 3)} == {1}
    assert len({got[i][0].score for i in (1, 2, 3)}) == 1
    assert got[None][0].held_out is (zlib.crc32(b"") % 7 == 2)
    assert all(r.held_out is (zlib.crc32(str(i).encode()) % 7 == 2) for i, rs in got.items() if i is not None for r in rs)
    assert got[6][0].score == got[6][1].score == got[7][0].score
    assert all(math.isfinite(r.score) and r.score < 0 for rs in got.values() for r in rs)
    assert context_tree.report(empty).count() == 0


def test_context_tree_without_training_rows(edge):
    got = context_tree.score(edge.where("doc_id = 4"), F.lit(True)).collect()[0]
    assert got.train_tokens == 0 and got.n_known == 0 and got.base_score == 0.0
    assert math.isclose(got.score, -5 * 8 * math.log10(2))  # "word" and the end, 8 bits each


def test_licences(spark, make, edge, empty):
    got = by_id(licences.scan(edge, licences.known(spark)))
    assert sum(map(len, got.values())) == N
    assert {got[i][0].digest for i in (1, 2, 3)} == {NOTHING} and {got[i][0].licence for i in (1, 2, 3)} == {None}
    mit = dict(reversed(licences.KNOWN))["MIT"]
    text = "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,").replace("SUBLICENSE", "SUBLICENCE") + "\n(c) Others"
    rows = [(1, text, "en", "a", 1), (2, "Prose.\nreleased under the MIT licence!!\nmore", "en", "a", 1), (3, mit + " more", "en", "a", 1)]
    found = by_id(licences.scan(make(rows), licences.known(spark)))
    assert found[1][0].licence == "MIT" and found[2][0].licence is None and found[2][0].notices == "MIT" and found[3][0].licence is None
    assert licences.scan(empty, licences.known(spark)).count() == 0
    nothing = licences.known(spark).limit(0)
    assert licences.scan(edge, nothing).where("licence IS NOT NULL OR notices <> ''").count() == 0


def test_licence_ties_and_null_names(spark, make):
    known = spark.createDataFrame([("B", "Some text."), ("A", "some  TEXT"), (None, "x"), ("C", None), ("D", " ")], "licence string, text string")
    got = by_id(licences.scan(make([(1, "Some, text", "en", "a", 1), (2, "x", "en", "a", 1), (3, "", "en", "a", 1)]), known))
    assert [got[i][0].licence for i in (1, 2, 3)] == ["A", None, None]


def test_ordinal(edge, empty, labels):
    got = by_id(ordinal.report(edge, labels))
    assert sum(map(len, got.values())) == N
    assert len({got[i][0].p_good for i in (1, 2, 3)}) == 1 and got[6][0].p_good == got[7][0].p_good
    assert all(0 <= r.p_clean <= r.p_good <= 1 for rs in got.values() for r in rs)
    assert ordinal.report(empty, labels).count() == 0
    blind = ordinal.report(edge, labels.limit(0)).collect()
    assert {r.p_good for r in blind} == {0.5} and all(r.keep for r in blind)
    kept = ordinal.select(edge, labels)
    assert kept.columns == edge.columns and kept.count() == sum(r.keep for rs in got.values() for r in rs)


def test_secrets(edge, empty):
    got = by_id(secrets.report(edge))
    assert sum(map(len, got.values())) == N
    assert {got[i][0].base_sha256 for i in (1, 2, 3)} == {NOTHING} and {got[i][0].spans for i in (1, 2, 3)} == {""}
    assert secrets.report(empty).count() == 0
    again = secrets.redact(edge)
    assert again.columns == edge.columns and again.count() == N
    assert again.where("text LIKE '%[secret]%'").count() == 0 and secrets.redact(empty).count() == 0


def test_near_duplicates(edge, empty):
    got = by_id(chosen_path.join(edge))
    assert sum(map(len, got.values())) == N
    assert {(r.class_id, r.n_links, r.n_copies) for i in (6, 7) for r in got[i]} == {(6, 2, 2)}
    assert {(got[i][0].class_id, got[i][0].n_links) for i in (1, 2, 3, 4, 10)} == {(i, 0) for i in (1, 2, 3, 4, 10)}
    assert got[None][0].class_id is None
    assert chosen_path.join(empty).count() == 0
    kept = chosen_path.deduplicate(edge)
    assert kept.columns == edge.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([None, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11], key=str)
    assert chosen_path.deduplicate(empty).count() == 0


def test_phrase_index(spark, edge, empty):
    bench = spark.createDataFrame([(1, "two ROWS with one id"), (2, None), (3, ""), (None, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15"),
                                   (1, "nul bytes"), (4, "absent words")], "item_id long, text string").withColumn("digest", F.lit(1))
    got = by_id(phrase_index.report(edge, bench))
    assert sum(map(len, got.values())) == N
    assert [(got[i][0].n_words, got[i][0].n_hit, got[i][0].contaminated) for i in (1, 2, 3)] == [(0, 0, False)] * 3
    assert {(r.n_hit, r.n_items, r.items_sha256) for i in (6, 7) for r in got[i]} == {(5, 1, hashlib.sha256(b"1").hexdigest())}
    assert (got[11][0].n_hit, got[11][0].n_items) == (2, 1)
    assert got[5][0].n_hit == 11 and got[5][0].items_sha256 == NOTHING and got[5][0].n_items == 1
    assert phrase_index.report(empty, bench).count() == 0
    assert phrase_index.report(edge, bench.limit(0)).where("contaminated OR n_near > 0").count() == 0
    kept = phrase_index.decontaminate(edge, bench)
    assert kept.columns == edge.columns and kept.count() == N - 5


def test_url_rules(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x"), (5, "http://example.net/fr/"), (6, "http://notexample.com/de/1"),
            (7, "https://example.com/de/"), (8, "https://www.w.org/fr/a?q=1#f"), (9, "ftp://net"), (9, "ftp://net/"), (None, "http://x.org/de?z://y"),
            (10, "http://"), (11, "http:///p"), (12, "http://ünï.net/" + "a/" * 5000)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("tokens", F.lit(1))
    got = {}
    for r in url_rules.judge(pages).collect():
        got.setdefault(r.page_id, []).append(r)
    pick = lambda i, k=0: (sorted(got[i], key=lambda r: r.path)[k].host, sorted(got[i], key=lambda r: r.path)[k].rule)
    assert pick(1) == pick(2) == pick(3) == ("", None)
    assert pick(4) == ("a.example.net", "example.net/en/") and pick(5) == ("example.net", "net/")
    assert pick(6) == ("notexample.com", None) and pick(7) == ("example.com", "example.com/de/") and pick(8) == ("www.w.org", "org/fr/")
    assert pick(9, 0) == ("net", None) and pick(9, 1) == ("net", "net/")
    assert pick(10) == ("", None) and pick(11) == ("", None) and pick(12)[1] == "net/"
    assert {r.verdict for rs in got.values() for r in rs if r.rule == "net/"} == {"block"}
    assert sum(map(len, got.values())) == len(urls)
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_url_rules_longest_rule_wins(spark):
    pages = spark.createDataFrame([(1, "http://b.a.net/x/y"), (2, "http://a.net/x/z"), (3, "http://c.net/x/y")], "page_id long, url string")
    rules = (("net", "/", "block"), ("a.net", "/x/", "allow"), ("a.net", "/x/y", "block"))
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    assert got == {1: ("a.net/x/y", "block"), 2: ("a.net/x/", "allow"), 3: ("net/", "block")}


def test_toxicity(edge, empty, labels):
    got = by_id(toxicity.report(edge, labels))
    assert sum(map(len, got.values())) == N
    assert len({got[i][0].score for i in (1, 2, 3)}) == 1 and got[6][0].score == got[7][0].score
    for i, rs in got.items():
        for r in rs:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
            assert r.held_out is (zlib.crc32(b"" if i is None else str(i).encode()) % 3 == 1)
    assert toxicity.report(empty, labels).count() == 0
    assert {r.score for r in toxicity.report(edge, labels.limit(0)).collect()} == {0.5}


def test_nearest(spark):
    v = lambda *x: list(map(float, x))
    rows = [(0, v(1, 0)), (1, v(1, 0)), (2, v(1, 0.1)), (3, v(0, 0)), (4, None), (5, [1.0, None]), (6, v(float("nan"), 1)), (7, v(float("inf"), 1)),
            (50, v(0, 2)), (51, v(0, 1)), (52, v(1)), (None, v(1, 1)), (53, v(-1, 0)), (53, v(-1, 0)), (100, v(1, 0)), (101, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))
    got = {}
    for r in nn_descent.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    near = round(1 / math.sqrt(1.01), 6)
    assert sorted(got[0]) == [(1, 1, 1.0), (2, 52, 1.0), (3, 100, 1.0), (4, 2, near), (5, 50, 0.0)]
    assert sorted(got[100])[:3] == [(1, 0, 1.0), (2, 1, 1.0), (3, 52, 1.0)]
    assert sorted(got[50])[0] == (1, 51, 1.0) and set(got) == {0, 50, 100}
    assert nn_descent.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert nn_descent.nearest(table.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
