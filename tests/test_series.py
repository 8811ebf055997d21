"""Resampling, scans, folds, compass, stamps, sinks and readers on edge tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.functions.compass import COMPASS_DEGREES, compass_angle
from brisa.functions.stamps import parse_stamp, stamp_text
from brisa.operators import evaluate as EV
from brisa.operators import timeseries as TS
from brisa.plans import wind as W
from brisa.session import scratch_path
from brisa.sources import files as FS
from brisa.sources import scans as SC
from brisa.sources import sinks as SK


def ts(s):
    return dt.datetime.fromisoformat(s)


def _gen(spark):
    rows = [(ts("2024-01-01 01:30:00"), 4.0), (ts("2024-01-01 02:59:59"), 2.0),
            (ts("2024-01-01 03:00:00"), 9.0),           # exactly on a bin edge -> next bin
            (ts("2024-01-01 10:00:00"), float("nan")), (ts("2024-01-01 10:30:00"), -1.0),
            (ts("2024-01-01 11:00:00"), 5.0)]
    return spark.createDataFrame(rows, "time timestamp_ntz, Total double")


def test_resample_bins_left_closed_and_gaps(spark):
    g = TS.positive_values(_gen(spark), "Total")
    got = {r.time: r.Total for r in TS.resample_mean(g, "time", ["Total"]).collect()}
    assert got == {ts("2024-01-01 00:00:00"): 3.0, ts("2024-01-01 03:00:00"): 9.0,
                   ts("2024-01-01 09:00:00"): 5.0}
    filled = {r.time: r.Total for r in TS.resample_fill(g, "time", ["Total"], 180).collect()}
    assert filled[ts("2024-01-01 06:00:00")] is None and len(filled) == 4


def test_positive_filter_drops_nan_and_negative(spark):
    assert TS.positive_values(_gen(spark), "Total").count() == 4


def test_scans_use_explicit_as_of(spark):
    g = _gen(spark)
    assert SC.trailing_window(g, "time", "2024-01-01 12:00:00", 0).count() == 0
    assert SC.bounded_history(g, "time", "2024-01-01 03:00:00", 1).count() == 3
    assert SC.future_horizon(g, "time", "2024-01-01 10:00:00").count() == 2


def test_compass_all_points_and_unknown(spark):
    pts = list(COMPASS_DEGREES) + ["XYZ", None]
    df = spark.createDataFrame([(p,) for p in pts], "d string")
    got = {r.d: r.a for r in df.select("d", compass_angle("d").alias("a")).collect()}
    assert [got[p] for p in COMPASS_DEGREES] == [i * 22.5 for i in range(16)]
    assert got["XYZ"] is None
    with pytest.raises(Exception):
        df.select(compass_angle("d", strict=True)).collect()


def test_stamp_text_order_differs_from_time_order(spark):
    times = [ts("2022-05-15 17:59:31"), ts("2022-05-15 18:00:01"), ts("2022-05-15 18:13:58")]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    r = df.select(stamp_text("t").alias("s")).withColumn("back", parse_stamp("s")).collect()
    assert [x.s for x in r] == ["2022-5-15-17-59-31", "2022-5-15-18-0-1", "2022-5-15-18-13-58"]
    assert [x.back for x in r] == times
    # un-padded text does not sort like time: 9 o'clock sorts after 18 o'clock
    nine = spark.createDataFrame([(ts("2022-05-15 09:05:00"),)], "t timestamp_ntz").select(stamp_text("t")).first()[0]
    assert nine == "2022-5-15-9-5-0" and nine > r[1].s


def test_latest_prediction_per_time(spark, tmp_dir):
    path = scratch_path(spark, "pred-test")
    base = spark.createDataFrame([(ts("2022-05-16 00:00:00"), 1, 1.0)], "time timestamp_ntz, id int, prediction double")
    for i, st in enumerate([ts("2022-05-15 18:13:58"), ts("2022-05-15 17:59:31"), ts("2022-05-15 18:00:01")]):
        SK.save_predictions(base.withColumn("prediction", F.lit(float(i))), path, st)
    saved = SK.load_predictions(spark, path)
    assert saved.count() == 3
    latest = W.latest_predictions(saved).first()
    assert latest.prediction == 0.0 and latest.prediction_stamp == "2022-5-15-18-13-58"


def test_prediction_csv_reader(spark, tmp_dir):
    p = f"{tmp_dir}/run-1.csv"
    with open(p, "w") as f:
        f.write("time,Direction,Lead_hours,Source_time,Speed,Angle,Generated Power Prediction,prediction_time\n")
        f.write("2021-03-04 06:00:00,W,2,1614800000,7.25,270.0,11.5,2021-3-4-5-6-7\n")
    schema = ("time string, Direction string, Lead_hours int, Source_time long, Speed double, Angle double, "
              "`Generated Power Prediction` double, prediction_time string")
    r = SK.load_prediction_csvs(spark, tmp_dir, schema).first()
    assert r.prediction_time == ts("2021-03-04 05:06:07") and r.Lead_hours == 2


def test_expanding_folds_arithmetic(spark):
    df = spark.range(240).select(F.col("id").alias("v"))
    f = EV.expanding_folds(df, ["v"], 5).toPandas()
    for i in range(5):
        tr, te = f[(f.fold == i) & (f.role == "train")], f[(f.fold == i) & (f.role == "test")]
        assert len(te) == 40 and len(tr) == 40 * (i + 1)
        assert tr.idx.max() < te.idx.min()
    assert (f.idx == f.v).all()


def test_row_index_per_key_with_hot_key(spark):
    df = spark.range(3000).select((F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 7 + 1)).alias("k"),
                                  F.col("id").alias("t"))
    idx = EV.row_index(df.repartition(5), ["t"], ["k"]).toPandas()
    for _, g in idx.groupby("k"):
        assert sorted(g.idx) == list(range(len(g)))
        assert list(g.sort_values("t").idx) == list(range(len(g)))


def test_json_lines_missing_field_and_corrupt_line(spark, tmp_dir):
    p = f"{tmp_dir}/x.jsonl"
    with open(p, "w") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": 2}\n{broken\n')
    df = FS.read_jsonl(spark, p, "a int, b string, _corrupt string", corrupt_col="_corrupt")
    r = sorted(df.collect(), key=lambda x: (x.a is None, x.a or 0))
    assert (r[0].a, r[0].b) == (1, "x") and r[1].b is None and r[2]._corrupt == "{broken"


def test_json_array_file_and_multiline_trap(spark, tmp_dir):
    arr = f"{tmp_dir}/arr"
    src = spark.range(50).select(F.col("id"), F.concat(F.lit("v"), F.col("id")).alias("s")).repartition(3)
    FS.write_json_arrays(src, arr)
    back = FS.read_json_multiline(spark, arr, "id long, s string")
    assert back.count() == 50
    lines = f"{tmp_dir}/lines.jsonl"
    with open(lines, "w") as f:
        f.write('{"id": 1}\n{"id": 2}\n{"id": 3}\n')
    assert FS.read_json_multiline(spark, lines, "id long").count() == 1   # the multiLine trap


def test_csv_roundtrip_with_newlines_quotes_commas(spark, tmp_dir):
    texts = ['a "quoted" word', "line1\nline2", "comma, here", "back\\slash", "  padded  ", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    FS.write_csv(df, f"{tmp_dir}/csv")
    back = {r.id: r.text for r in FS.read_csv(spark, f"{tmp_dir}/csv", "id int, text string").collect()}
    assert back == dict(enumerate(texts))


def test_model_store_roundtrip(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 1.0, 1.0, 3.0)], "id long, x1 double, x2 double, y double")
    path = scratch_path(spark, "model-test")
    SK.save_model(rows, 2, path)
    back, k = SK.load_model(spark, path)
    assert k == 2 and back.count() == 2


def test_run_log_search(spark):
    path = scratch_path(spark, "runs-test")
    at = ts("2022-05-19 13:27:01")
    SK.log_run(spark, path, "r1", {"model": "KNN"}, {"Score": 0.5}, at)
    SK.log_run(spark, path, "r2", {"model": "KNN"}, {"Score": 0.7}, at)
    wide = {r.run_id: r for r in SK.search_runs(spark, path, ["model"], ["Score"]).collect()}
    assert wide["r2"].Score == 0.7 and wide["r1"].model == "KNN"


def test_newest_source_covering_fewer_times(spark):
    from brisa.operators.relational import newest_rows
    rows = [(ts("2024-01-02 00:00:00"), 100, "N", 5.0), (ts("2024-01-02 03:00:00"), 100, "E", 6.0),
            (ts("2024-01-02 06:00:00"), 100, "S", 7.0), (ts("2024-01-02 03:00:00"), 200, "W", 8.0)]
    fc = spark.createDataFrame(rows, "time timestamp_ntz, Source_time long, Direction string, Speed double")
    got = newest_rows(fc, "Source_time").collect()
    assert [(r.Source_time, r.Direction) for r in got] == [(200, "W")]
    feats = W.newest_forecast_features(fc, "2024-01-02 01:00:00").collect()
    assert [(r.Direction, r.Angle) for r in feats] == [("W", 270.0)]


# --- storage, session and scratch folders

def test_json_arrays_survive_a_row_limit_on_files(spark, tmp_dir):
    from brisa.sources.files import read_json_multiline, write_json_arrays
    df = spark.range(10).selectExpr("id", "IF(id % 3 = 0, NULL, concat('t', id)) AS t").repartition(2)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 3)
    try:
        write_json_arrays(df, f"{tmp_dir}/a")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    back = read_json_multiline(spark, f"{tmp_dir}/a", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_history_csv_keeps_nulls_and_checks_the_header(spark, tmp_dir):
    from brisa.sources.files import write_csv
    from brisa.sources.sinks import load_prediction_csvs
    rows = [(1, "2024-01-05 03:00:00", None, 1.5, "2024-1-9-1-2-3"), (2, None, "", None, "2024-1-9-1-2-3")]
    write_csv(spark.createDataFrame(rows, "event_id long, time string, Direction string, p double, prediction_time string"), f"{tmp_dir}/h")
    got = load_prediction_csvs(spark, f"{tmp_dir}/h", "event_id long, time string, Direction string, p double, prediction_time string", {"p": "prediction"})
    assert dict(got.dtypes)["time"] == "timestamp_ntz" and "prediction" in got.columns
    assert sorted((r.event_id, r.Direction, r.prediction) for r in got.collect()) == [(1, None, 1.5), (2, "", None)]
    with pytest.raises(Exception):
        load_prediction_csvs(spark, f"{tmp_dir}/h", "event_id long, other string, Direction string, p double, prediction_time string").collect()


def test_replayed_stream_batch_adds_no_rows(spark, tmp_dir):
    import shutil
    from brisa.sources import sinks as SK
    from brisa.streaming import score_new_forecasts
    model = spark.createDataFrame([(1, 5.0, 0.0, 10.0), (2, 6.0, 22.5, 20.0)], "event_id long, Speed double, Angle double, Energy double")
    SK.save_model(model, 1, f"{tmp_dir}/m")
    fc = spark.createDataFrame([(7, "N", 5.1, 1), (8, "XX", 5.0, 2), (9, None, 6.0, 2)], "event_id long, Direction string, Speed double, Source_time long")
    fc.coalesce(1).write.parquet(f"{tmp_dir}/in")
    args = (spark, f"{tmp_dir}/in", fc.schema, f"{tmp_dir}/m", f"{tmp_dir}/out")
    score_new_forecasts(*args, f"{tmp_dir}/ck1")
    score_new_forecasts(*args, f"{tmp_dir}/ck1")
    got = sorted((r.event_id, r.prediction) for r in SK.load_predictions(spark, f"{tmp_dir}/out").collect())
    assert got == [(7, 10.0), (8, None), (9, None)]
    shutil.rmtree(f"{tmp_dir}/ck1/commits")  # as if the job had died before the batch was committed
    score_new_forecasts(*args, f"{tmp_dir}/ck1")
    assert SK.load_predictions(spark, f"{tmp_dir}/out").count() == 3


def test_scoring_keeps_every_forecast(spark):
    from brisa.functions.compass import compass_angle
    from brisa.plans import wind as W
    model = spark.createDataFrame([(1, 5.0, 0.0, 10.0)], "id long, Speed double, Angle double, Energy double")
    fc = spark.createDataFrame([(1, "N", 5.0), (2, "XX", 5.0), (3, None, 5.0)], "id long, Direction string, Speed double")
    fc = fc.withColumn("Angle", compass_angle("Direction"))
    assert sorted((r.id, r.prediction) for r in W.score_forecasts(model, 1, fc, "id").collect()) == [(1, 10.0), (2, None), (3, None)]
    assert W.unusable_forecasts(fc).first().n == 2
    with pytest.raises(Exception):
        W.score_forecasts(model, 1, fc, "id", strict=True).collect()


def test_latest_value_of_a_run_counts_and_metrics_are_numbers(spark, tmp_dir):
    import datetime as dt
    from brisa.sources import sinks as SK
    SK.log_run(spark, tmp_dir + "/r", "a", {"m": "x"}, {"s": 2.0}, dt.datetime(2024, 1, 2))
    SK.log_run(spark, tmp_dir + "/r", "a", {"m": "old"}, {"s": 1.0}, dt.datetime(2024, 1, 1))
    assert [tuple(r) for r in SK.search_runs(spark, tmp_dir + "/r", ["m"], ["s", "none"]).collect()] == [("a", "x", 2.0, None)]


def test_best_k_needs_every_fold(spark):
    from brisa.plans.wind import best_k
    cv = spark.createDataFrame([(1, 0.5, 5), (2, 0.9, 2), (3, 0.5, 5)], "k long, mean_r2 double, folds long")
    assert best_k(cv).first()["k"] == 1


def test_scratch_scope_leaves_nothing(spark):
    import os
    from brisa.session import scratch_path, scratch_scope
    with scratch_scope(spark) as folder:
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert path.startswith(folder) and spark.read.parquet(path).count() == 3
    assert not os.path.exists(folder.removeprefix("file:")) and "scope-" not in scratch_path(spark, "y")


def test_no_shared_folder_on_a_cluster_raises(monkeypatch):
    from types import SimpleNamespace
    from brisa.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))


def test_keyed_row_index_with_a_hot_key(spark):
    from brisa.operators.evaluate import row_index
    df = spark.range(400).selectExpr("id", "IF(id % 3 = 0, 'hot', IF(id % 50 = 1, NULL, concat('k', id % 20))) AS k", "(id * 37) % 400 AS o")
    got = row_index(df, ["o"], ["k"], count_col="n").collect()
    for k in {r.k for r in got}:
        mine = sorted((r for r in got if r.k == k), key=lambda r: r.o)
        assert [r.idx for r in mine] == list(range(len(mine))) and {r.n for r in mine} == {len(mine)}


def test_e9_ratio_reads_the_texts_once(spark):
    import __spark_entry__ as E
    plan = E.queries()["e9_region_ratio_literal"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text#") and plan.count("Relation [doc_id") == 1


def test_payload_names_and_rows_are_both_decoded(spark):
    from brisa.sources.files import decode_payload
    texts = ['{"columns": ["b", "time"], "values": [["1.5", "2024-01-01 00:00:00"], ["x", null]]}', '{"columns": ["time"], "values": []}', "broken", None]
    got = decode_payload(spark.createDataFrame([(t,) for t in texts], "p string"), "p", {"time": "timestamp_ntz", "b": "double", "c": "string"})
    assert sorted((str(r.time), r.b, r.c) for r in got.collect()) == [("2024-01-01 00:00:00", 1.5, None), ("None", None, None)]


def test_approximate_distinct_count(spark):
    from brisa.operators.relational import distinct_count_having
    df = spark.range(200).selectExpr("id % 2 AS k", "id % 40 AS x")
    assert {r.k for r in distinct_count_having(df, "k", "x", 10, approx=True).collect()} == {0, 1}
