"""Stored forms of the tables: what they read, what a repeated or broken write leaves, and that answers stay the same."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from brisa.functions import text as TX
from brisa.operators import partials as PA
from brisa.operators import word_index as WI
from brisa.plans import catalog_stores as CS
from brisa.plans import jobs as J
from brisa.plans import wind as W
from brisa.sources import ingest as IN
from brisa.sources import series as SE
from brisa.sources import sinks as SK
from brisa.sources import star as ST
from brisa.sources import versions as VS
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


# ------------------------------------------------------------------ series
def test_scans_read_only_their_days(spark):
    series = CS._series(spark, SF_SMALL)
    whole = series.inputFiles()
    for name, df in CS.series_scans(series).items():
        text = plan(df)
        found = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
        assert "day" in found and "2024-01" in found, (name, found)
        assert ("<=" in found) == (name == "history")
        assert "PushedFilters" in text and "time" in re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
        read = df.select(F.input_file_name().alias("f")).distinct().collect()
        low = "2024-01-25" if name == "horizon" else "2024-01-15"
        assert all(r.f.split("day=")[1][:10] >= low for r in read) and 0 < len(read) < len(whole)


def test_loads_replace_their_days(spark, tmp_dir):
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    kinds = "time timestamp_ntz, v int"
    SE.write_series(spark.createDataFrame([(at(1, 0), 1), (at(1, 23), 2), (at(2, 5), 3), (None, 9)], kinds), tmp_dir + "/s")
    SE.write_series(spark.createDataFrame([(at(2, 5), 30), (at(2, 6), 31), (at(3, 0), 40)], kinds), tmp_dir + "/s")
    read = SE.read_series(spark, tmp_dir + "/s", kinds)
    assert sorted((r.time, r.v) for r in read.collect()) == [(at(1, 0), 1), (at(1, 23), 2), (at(2, 5), 30), (at(2, 6), 31), (at(3, 0), 40)]
    got = SE.between(read, "time", "2024-01-01 23:00:00", at(2, 6)).collect()
    assert sorted(r.v for r in got) == [2, 30]
    assert SE.missing_times(spark.createDataFrame([(None, 9), (at(1, 1), 1)], kinds)).first().n == 1
    assert SE.trailing_window(read, "time", at(2, 5), 1).count() == 4  # later than 1st 05:00
    assert SE.future_horizon(read, "time", at(2, 6)).count() == 1


def test_a_hot_day_is_written_by_many_tasks(spark, tmp_dir):
    rows = spark.range(40_000).select((F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 86_000)).alias("time"), "id")
    SE.write_series(rows, tmp_dir + "/s", files_per_task=6)
    files = [f for f in os.listdir(tmp_dir + "/s/day=2024-03-01") if f.endswith(".parquet")]
    assert 4 <= len(files) <= 7 and SE.read_series(spark, tmp_dir + "/s").count() == 40_000


# ------------------------------------------------------------------ ingest
LINES = ['{"id": 1, "text": "a\\nb", "n": 2.5}', "{broken", "", '{"id": "x", "text": "t"}', '{"id": 4}', "[1, 2", '{"text": "no id"}', "null", '{"id": 5, "other": 1, "n": null}']


def test_quarantine_keeps_each_bad_line(spark, tmp_dir):
    with open(tmp_dir + "/in.json", "w") as f:
        f.write("\n".join(LINES))
    got = IN.ingest_jsonl(spark, tmp_dir + "/in.json", "id long, text string, n double", tmp_dir + "/out", required=("id",))
    assert sorted((r.id, r.text, r.n) for r in got.rows().collect()) == [(1, "a\nb", 2.5), (4, None, None), (5, None, None)]
    bad = got.quarantine().collect()
    assert {"{broken", "[1, 2", '{"id": "x", "text": "t"}', '{"text":"no id"}'} <= {r.line for r in bad} and {r.file for r in bad} == {"in.json"}
    n = got.counts().first()
    assert n.n_rows == 3 and n.n_quarantined == len(bad)
    again = IN.ingested(spark, "id long, text string, n double", tmp_dir + "/out")
    assert again.rows().count() == 3
    checked = IN.ingest_jsonl(spark, tmp_dir + "/in.json", "id long, text string, n double", tmp_dir + "/out", required=("id",), check=F.col("id") < 5)
    assert sorted(r.id for r in checked.rows().collect()) == [1, 4]


def test_ingest_of_nothing(spark, tmp_dir):
    open(tmp_dir + "/in.json", "w").close()
    got = IN.ingest_jsonl(spark, tmp_dir + "/in.json", "id long", tmp_dir + "/out")
    assert got.counts().first().n_rows == 0


def test_review_job_parses_each_file_once(spark, tmp_dir):
    for name, rows in (("review", [{"review_id": "r1", "user_id": "u1", "business_id": "b1", "stars": 5.0, "text": "authentic but rude"}]),
                       ("business", [{"business_id": "b1", "name": "n", "state": "AZ", "city": "c", "categories": "Restaurants, Mexican", "stars": 5.0, "review_count": 2000}]),
                       ("user", [{"user_id": "u1", "review_count": 1001, "average_stars": 4.0}])):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write("\n".join([*map(json.dumps, rows), "{cut"]))
    out = J.review_job(spark, *(f"{tmp_dir}/{n}.json" for n in ("review", "business", "user")), store=f"{tmp_dir}/store")
    for name, df in out.items():
        text = plan(df)
        assert "Scan json" not in text and "FileScan json" not in text, name
        if name not in ("quarantine", "ingest"):
            for part in ("review", "business", "user"):
                scans = re.findall(rf"FileScan parquet.*?Location: [^\n]*?/store/{part}[,\]]", text)
                assert len(scans) <= 1, (name, part)
    assert {(r.input, r.n_rows, r.n_quarantined) for r in out["ingest"].collect()} == {("review", 1, 1), ("business", 1, 1), ("user", 1, 1)}
    assert {r.line for r in out["quarantine"].collect()} == {"{cut"}
    assert out["e6_word_share"].first().matching == 1 and out["e10_good_reviews"].count() == 1


# ------------------------------------------------------------------ word index
TEXTS = [(1, "authentic tacos"), (2, "Unauthentic!\nrude, dirty"), (3, None), (4, ""), (5, " \t "), (6, "not good at all"), (7, "nothing good"), (8, "not  good"), (9, "cannot goodness")]


@pytest.fixture
def index(spark, tmp_dir):
    texts = spark.createDataFrame(TEXTS, "review_id long, text string")
    return texts, WI.build(texts, tmp_dir + "/index")


@pytest.mark.parametrize("terms", [["authentic"], ["rude", "dirty", "none"], ["not good"], ["not good", "taco", " good", "good ", "t g"], ["%", "_"], ["\n"], [" "], ["  "]])
def test_index_equals_scan(spark, index, terms):
    texts, idx = index
    found, marks = idx.lookup(terms, texts)
    got = {r.review_id: [r[marks.names[t]] for t in terms] for r in found.collect()}
    want = {i: [t in (text or "") for t in terms] for i, text in TEXTS}
    assert {i: m for i, m in got.items() if any(m)} == {i: m for i, m in want.items() if any(m)}


def test_lexicon_predicates_run_on_marks(spark, index):
    texts, idx = index
    marked, marks = idx.mark(texts.drop("text"), ["authentic", "good", "rude", "dirty"])
    for form in (TX.lexicon_literal, TX.lexicon_intended, TX.complement_literal, TX.complement_intended):
        got = {r.review_id for r in marked.filter(form(marks, ["authentic", "good"], ["rude", "dirty"])).collect()}
        assert got == {r.review_id for r in texts.filter(form("text", ["authentic", "good"], ["rude", "dirty"])).collect()}
    assert marked.count() == len(TEXTS)


def test_plain_terms_do_not_read_texts(spark, index, tmp_dir):
    _, idx = index
    found, _ = idx.lookup(["authentic", "rude"])
    text = plan(found)
    assert text.count("FileScan") == 1 and "ReadSchema: struct<token:string,ids:array<bigint>>" in text and "StringContains(token,authentic)" in text
    with pytest.raises(ValueError):
        idx.lookup(["not good"])


def test_hot_tokens_are_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(WI, "BLOCK_TEXTS", 100)
    texts = spark.range(1000).select(F.col("id").alias("review_id"), F.concat(F.lit("the the x"), F.col("id") % 7).alias("text"))
    idx = WI.build(texts, tmp_dir + "/index")
    sizes = idx.tokens.select("token", F.size("ids").alias("n"), (F.array_sort("ids") == F.col("ids")).alias("sorted")).collect()
    assert max(r.n for r in sizes) <= 160 and sum(r.n for r in sizes if r.token == "the") == 1000 and all(r.sorted for r in sizes)
    assert {r.token: r.n for r in WI.token_counts(idx).collect()}["the"] == 1000


# ------------------------------------------------------------------ star
def test_star_joins_without_exchange(spark):
    reviews = spark.range(3000).select(F.col("id").alias("review_id"), (F.col("id") % 50).alias("business_id"), (F.col("id") % 70).alias("user_id"))
    business = spark.range(50).select(F.col("id").alias("business_id"), (F.col("id") % 5).alias("state"))
    users = spark.range(70).select(F.col("id").alias("user_id"), (F.col("id") * 30).alias("review_count"))
    star = ST.review_star(spark, reviews, business, users, buckets=6)
    try:
        for df in (star.meet("reviews_by_business", "business", "business_id"), star.meet("reviews_by_user", "users", "user_id", "left_semi"),
                   star.meet("reviews_by_business", "business", "business_id").groupBy("business_id", "state").agg(F.count("*").alias("n"))):
            text = final_plan(df)
            assert "SortMergeJoin" in text and "Exchange" not in text and "Broadcast" not in text
        assert star.meet("reviews_by_business", "business", "business_id", columns=("state",)).count() == 3000
        influencers = star["users"].filter("review_count > 1000")
        got = star["reviews_by_user"].join(influencers.hint("merge"), "user_id", "left_semi")
        assert "Exchange" not in final_plan(got) and got.count() == reviews.join(users.filter("review_count > 1000"), "user_id").count()
        assert len(spark.sql(f"DESCRIBE EXTENDED {star.tables['business']}").filter("col_name = 'Num Buckets' AND data_type = '6'").collect()) == 1
    finally:
        star.drop()
    assert not star.tables


# ------------------------------------------------------------------ partials
def test_partials_of_two_loads_are_the_cube_of_the_whole(spark, tmp_dir):
    rows = spark.createDataFrame([("AZ", "p", "x"), ("AZ", None, "xy"), (None, None, "y"), ("NV", "q", None), ("AZ", "p", "z")], "state string, city string, text string")
    cube = PA.CubePartials(spark, tmp_dir + "/cube", ("state", "city"))
    first, second = rows.limit(2), rows.subtract(rows.limit(2))
    cube.add("a", first, F.col("text").contains("x"))
    cube.add("b", first, F.col("text").contains("x"))
    cube.add("b", second, F.col("text").contains("x"))  # the load is corrected: it replaces itself
    want = first.unionByName(second)
    match = F.count_if(F.col("text").contains("x"))
    direct = want.cube("state", "city").agg(F.count("*").alias("n"), match.alias("m"), F.grouping_id().alias("gid"))
    key = lambda r: (r.gid, str(r.state), str(r.city), r.n, r.m)
    assert sorted(map(key, cube.cube().collect())) == sorted(map(key, direct.collect()))
    assert {(r.load_id, r.n) for r in cube.loads().collect()} == {("a", 2), ("b", second.count())}
    assert "text" not in plan(cube.cube())


def test_sketches_merge_within_their_error(spark, tmp_dir):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("business_id"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user_id"),
                                      F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 10 * 86_400).cast("timestamp_ntz").alias("time"))
    sk = PA.DistinctSketches(spark, tmp_dir + "/sketches", ("business_id",))
    sk.add("one", rows.filter("user_id < 12000"), "user_id", "time")
    sk.add("two", rows.filter("user_id >= 8000"), "user_id", "time")  # the loads overlap
    sk.add("two", rows.filter("user_id >= 8000"), "user_id", "time")
    for since in (None, "2024-01-08"):
        some = rows if since is None else rows.filter(F.col("time") >= F.lit(since).cast("timestamp_ntz"))
        exact = {r.business_id: r.n for r in some.groupBy("business_id").agg(F.count_distinct("user_id").alias("n")).collect()}
        got = {r.business_id: r.users for r in sk.estimates(since=since).collect()}
        assert got.keys() == exact.keys() and all(abs(got[b] - n) <= 4 * sk.error * n for b, n in exact.items())
    total = sk.estimates(by=()).first().users
    exact = rows.select("user_id").distinct().count()
    assert abs(total - exact) <= 4 * sk.error * exact
    assert sk.having(10 ** 9).count() == 0 and sk.having(10).count() == 3


# ------------------------------------------------------------------ runs, versions, log
def test_a_saved_run_replaces_itself(spark, tmp_dir):
    rows = lambda v: spark.createDataFrame([(1, v), (2, v)], "id long, prediction double")
    at = [dt.datetime(2024, 1, 9, 23, 59, 5), dt.datetime(2024, 1, 10, 0, 0, 7)]
    for i, v in ((0, 1.0), (1, 2.0), (0, 3.0)):
        SK.save_predictions(rows(v), tmp_dir + "/p", at[i])
    got = SK.load_predictions(spark, tmp_dir + "/p")
    assert sorted((r.id, r.prediction, r.prediction_time) for r in got.collect()) == [(1, 2.0, at[1]), (1, 3.0, at[0]), (2, 2.0, at[1]), (2, 3.0, at[0])]
    assert "PartitionFilters: [isnotnull(prediction_date" in plan(got.filter(F.col("prediction_date") >= dt.date(2024, 1, 10)))
    SK.save_predictions(rows(4.0), tmp_dir + "/p", at[0], run="named")
    assert got.sparkSession.read.parquet(tmp_dir + "/p").count() == 6


def test_a_model_that_breaks_between_its_writes_is_not_seen(spark, tmp_dir, monkeypatch):
    rows = lambda v: spark.createDataFrame([(v, 1.0)], "id long, y double")
    path = tmp_dir + "/m"
    with pytest.raises(FileNotFoundError):
        SK.load_model(spark, path)
    SK.save_model(rows(1), 3, path)
    real = VS.publish
    monkeypatch.setattr(VS, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        SK.save_model(rows(2), 4, path)
    monkeypatch.setattr(VS, "publish", real)
    back, k = SK.load_model(spark, path)
    assert k == 3 and [r.id for r in back.collect()] == [1]
    for v in (3, 4, 5):
        SK.save_model(rows(v), v, path)
    assert len(VS.history(spark, path)) == 2 and SK.load_model(spark, path)[1] == 5
    assert VS.expire(spark, path, keep=1) == 1 and SK.load_model(spark, path)[1] == 5


def test_numbers_are_given_once(spark, tmp_dir):
    """A claim that another writer left takes its number, and the later publication counts."""
    path = tmp_dir + "/v"
    a, b = VS.begin(spark, path), VS.begin(spark, path)
    os.makedirs(f"{path}/{VS.MARKERS}")
    open(f"{path}/{VS.MARKERS}/000000000001", "w").close()  # a writer that died
    assert VS.current(spark, path) is None
    VS.publish(spark, path, a)
    VS.publish(spark, path, b)
    assert VS.current(spark, path) == b and VS.history(spark, path) == [a, b]
    assert [m for m in VS.files(spark, f"{path}/{VS.MARKERS}") if "-" in m][0].startswith("000000000002")


def test_compaction_keeps_every_search(spark, tmp_dir):
    path, at = tmp_dir + "/log", dt.datetime(2024, 1, 1)
    for i in range(12):
        SK.log_run(spark, path, f"run-{i % 3}", {"model": f"m{i}", "run_id": "odd"}, {"Score": float(i), "model": 1.0}, at + dt.timedelta(hours=i))
    SK.log_run(spark, path, "run-0", {}, {"Score": None}, at - dt.timedelta(days=1))
    wide = lambda: sorted(tuple(r) for r in SK.search_runs(spark, path).collect())
    before = wide()
    assert SK.run_keys(spark, path) == (["model", "run_id"], ["Score", "model"])
    assert before == [(f"run-{i}", f"m{9 + i}", "odd", 9.0 + i, 1.0) for i in range(3)]
    assert SK.search_runs(spark, path).columns == ["run_id", "model", "param_run_id", "Score", "metric_model"]
    folded = SK.compact_runs(spark, path)
    assert folded > 12 and wide() == before and not [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len([f for f in os.listdir(VS.current(spark, path)) if f.endswith(".parquet")]) == 1
    assert SK.compact_runs(spark, path) == 0
    SK.log_run(spark, path, "run-1", {}, {"Score": 99.0}, at + dt.timedelta(days=2))
    assert wide()[1][3] == 99.0
    SK.compact_runs(spark, path)
    SK.log_run(spark, path, "run-3", {"model": "new"}, {}, at)
    assert [r[0] for r in wide()] == ["run-0", "run-1", "run-2", "run-3"] and wide()[1][3] == 99.0
    assert SK.search_runs(spark, path, metrics=["Score"]).columns == ["run_id", "Score"]


def test_compaction_that_breaks_before_the_old_files_go(spark, tmp_dir, monkeypatch):
    path, at = tmp_dir + "/log", dt.datetime(2024, 1, 1)
    for i in range(4):
        SK.log_run(spark, path, "run", {}, {"Score": float(i)}, at + dt.timedelta(hours=i))
    monkeypatch.setattr(VS, "remove", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        SK.compact_runs(spark, path)
    assert SK.search_runs(spark, path).first().Score == 3.0


# ------------------------------------------------------------------ strict scoring
def test_strict_finds_each_unusable_feature(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, nan, 2.0), (4, 1.0, inf), (5, -inf, nan)], "id long, Speed double, Angle double")
    assert W.unusable_forecasts(rows).first().n == 4
    model = spark.createDataFrame([(1, 1.0, 2.0, 5.0)], "id long, Speed double, Angle double, Energy double")
    assert {r.id: r.prediction for r in W.score_forecasts(model, 1, rows, "id").collect()} == {1: 5.0, 2: None, 3: None, 4: None, 5: None}
    for bad in (3, 4):
        with pytest.raises(Exception, match="usable"):
            W.score_forecasts(model, 1, rows.filter(f"id = {bad}"), "id", strict=True).collect()


@pytest.mark.parametrize("name", ["bucketed_star", "bucketed_influencers"])
def test_buckets_grow_with_the_facts(spark, monkeypatch, name):
    """A bucket holds about as many rows whatever the table; one more bucket for each."""
    import __spark_entry__ as E
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(ST, "BUCKET_ROWS", n // 20)
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    want = -(-n // (n // 20))
    assert f"SelectedBucketsCount: {want} out of {want}" in plan
