"""Registered queries: split, nearest-neighbour regression, grid search,
scores, ordered folds, forecast scoring, prediction store, run log and
model store (M1-M10, K2-K6, E12, E14, E15)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from brisa.functions.compass import compass_angle
from brisa.functions.stamps import ntz_lit, stamp_text
from brisa.operators import evaluate as EV
from brisa.operators.timeseries import latest_per_key
from brisa.operators import knn as KNN
from brisa.plans import standins as S
from brisa.plans import wind as W
from brisa.plans.catalog_series import AS_OF, E11_SQL, HISTORY_DAYS, FC_SQL, GEN_SQL, ANGLE_SQL, training_set
from brisa.plans.registry import ORACLE, register
from brisa.plans.tables import table as T
from brisa.session import cut_lineage, scratch_path
from brisa.sources import files as FS
from brisa.sources import sinks as SK
from brisa.sources.scans import future_horizon

SEED = "420"
XY = ("x1", "x2")
K = 5
K_MAX = 99  # the original grid: k = 1..99
# Run stamps whose text order differs from their time order.
STAMPS = [_dt.datetime(2024, 1, 9, 23, 59, 5), _dt.datetime(2024, 1, 10, 0, 0, 7), _dt.datetime(2024, 1, 10, 11, 2, 30)]
STAMP_TEXT = ["2024-1-9-23-59-5", "2024-1-10-0-0-7", "2024-1-10-11-2-30"]


# ------------------------------------------------------------------ SQL helpers
def _md5(col):
    return f"md5(CAST({col} AS VARCHAR) || '{SEED}')"


def _split_cols(col):
    return (f"instr('0123456789abcdef', substr({_md5(col)}, 1, 1)) - 1 < 4 AS is_test, "
            f"('0x' || substr({_md5(col)}, 2, 4))::INTEGER % 5 AS fold")


WIND_SQL = f"""SELECT event_id AS id, Speed AS x1, Angle AS x2, Energy AS y, time, {_split_cols('event_id')}
    FROM ({E11_SQL})"""


def knn_sql(train_sql: str, test_sql: str, k: int, group: bool = False) -> str:
    """Brute-force oracle: every (query, training row) pair ranked by (d2, id)."""
    on = "t.g = q.g" if group else "TRUE"
    g = "q.g" if group else "0"
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, qid ORDER BY d2, rid) AS rk
      FROM (SELECT {g} AS g, q.id AS qid, t.id AS rid, t.y,
                   (q.x1 - t.x1) * (q.x1 - t.x1) + (q.x2 - t.x2) * (q.x2 - t.x2) AS d2
            FROM ({test_sql}) q JOIN ({train_sql}) t ON {on})) WHERE rk <= {k}"""


def r2_sql(pairs: str, by: str) -> str:
    """pairs has columns y, p and the ``by`` columns."""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""SELECT {sel}CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END AS r2, n
      FROM (SELECT {sel}sum((y - p) * (y - p)) AS ss_res, var_pop(y) * count(y) AS ss_tot, count(*) AS n
            FROM ({pairs}) {grp})"""


def grid_cv_sql(base: str, k_max: int) -> str:
    tr = f"SELECT * FROM ({base}) WHERE NOT is_test"
    train_side = f"SELECT t.*, f.g FROM ({tr}) t JOIN (SELECT unnest(range(5)) AS g) f ON f.g <> t.fold"
    test_side = f"SELECT *, fold AS g FROM ({tr})"
    nb = knn_sql(train_side, test_side, k_max, group=True)
    allk = f"""SELECT g, qid, rk AS k, avg(y) OVER (PARTITION BY g, qid ORDER BY rk
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM ({nb})"""
    pairs = f"SELECT a.g, a.k, a.p, b.y FROM ({allk}) a JOIN ({tr}) b ON b.id = a.qid"
    return f"SELECT k, avg(r2) AS mean_r2, count(*) AS folds FROM ({r2_sql(pairs, 'g, k')}) GROUP BY k"


def holdout_sql(base: str, k: int) -> str:
    nb = knn_sql(f"SELECT * FROM ({base}) WHERE NOT is_test", f"SELECT * FROM ({base}) WHERE is_test", k)
    pred = f"SELECT qid, avg(y) AS p FROM ({nb}) GROUP BY qid"
    return r2_sql(f"SELECT b.y, a.p FROM ({pred}) a JOIN ({base}) b ON b.id = a.qid", "")


def holdout_all_sql(base: str, k_max: int) -> str:
    """k, r2, n of the holdout for every k."""
    nb = knn_sql(f"SELECT * FROM ({base}) WHERE NOT is_test", f"SELECT * FROM ({base}) WHERE is_test", k_max)
    allk = f"""SELECT qid, rk AS k, avg(y) OVER (PARTITION BY qid ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM ({nb})"""
    return r2_sql(f"SELECT a.k, b.y, a.p FROM ({allk}) a JOIN ({base}) b ON b.id = a.qid", "k")


def best_k_sql(base: str, k_max: int) -> str:
    return f"SELECT k, mean_r2 FROM ({grid_cv_sql(base, k_max)}) WHERE folds = 5 ORDER BY mean_r2 DESC, k LIMIT 1"


# ------------------------------------------------------------------ Spark helpers
def wind_rows(spark, d):
    """The wind training set as (id, x1 = Speed, x2 = Angle, y = Energy) with its split."""
    t = training_set(spark, d).select(F.col("event_id").alias("id"), F.col("Speed").alias("x1"), F.col("Angle").alias("x2"),
                                      F.col("Energy").alias("y"))
    return KNN.hash_split(t, "id", SEED)


def _parts(spark, d):
    rows = cut_lineage(wind_rows(spark, d))  # read as training rows, as queries and as truth
    return rows.filter(~F.col("is_test")), rows.filter(F.col("is_test"))


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------------ M1-M5
@register("hash_split", f"SELECT vec_id, {_split_cols('vec_id').split(', (')[0]} FROM embeddings")
def hash_split(spark, d):
    return KNN.hash_split(T(spark, d, "embeddings"), "vec_id", SEED).select("vec_id", "is_test")


@register("knn_predict", f"""SELECT qid AS test_id, round(avg(y), 6) AS prediction FROM
    ({knn_sql(f"SELECT * FROM ({WIND_SQL}) WHERE NOT is_test", f"SELECT * FROM ({WIND_SQL}) WHERE is_test", K)})
    GROUP BY qid""")
def knn_predict(spark, d):
    tr, te = _parts(spark, d)
    p = KNN.knn_predict(tr, te, K)
    return p.select(F.col("qid").alias("test_id"), F.round("prediction", 6).alias("prediction"))


@register("knn_all_k", f"""SELECT qid AS test_id, rk AS k, round(avg(y) OVER (PARTITION BY qid ORDER BY rk
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS prediction FROM
    ({knn_sql(f"SELECT * FROM ({WIND_SQL}) WHERE NOT is_test", f"SELECT * FROM ({WIND_SQL}) WHERE is_test", K_MAX)})""")
def knn_all_k(spark, d):
    tr, te = _parts(spark, d)
    p = KNN.knn_all_k(tr, te, K_MAX)
    return p.select(F.col("qid").alias("test_id"), F.col("k").cast("bigint").alias("k"),
                    F.round("prediction", 6).alias("prediction"))


@register("knn_grid_cv", f"SELECT k, round(mean_r2, 6) AS mean_r2, folds FROM ({grid_cv_sql(WIND_SQL, K_MAX)})")
def knn_grid_cv(spark, d):
    tr, _ = _parts(spark, d)
    cv = W.grid_search_cv(tr, "id", "y", K_MAX, 5, SEED, XY)
    return cv.select(F.col("k").cast("bigint").alias("k"), _r6("mean_r2"), "folds")


def _holdout(spark, d, k):
    tr, te = _parts(spark, d)
    p = KNN.knn_predict(tr, te, k)
    truth = te.select(F.col("id").alias("qid"), "y")
    return EV.r2_score(p.join(truth, "qid"), "y", "prediction")


@register("r2", f"SELECT round(r2, 6) AS r2, n FROM ({holdout_sql(WIND_SQL, K)})")
def r2(spark, d):
    return _holdout(spark, d, K).select(_r6("r2"), "n")


@register("knn_refit", f"""SELECT b.k AS best_k, round(h.r2, 6) AS r2, h.n FROM ({best_k_sql(WIND_SQL, K_MAX)}) b
    JOIN ({holdout_all_sql(WIND_SQL, K_MAX)}) h ON h.k = b.k""")
def knn_refit(spark, d):
    tr, _ = _parts(spark, d)
    cv = W.grid_search_cv(tr, "id", "y", K_MAX, 5, SEED, XY)
    k = int(W.best_k(cv).first()["k"])
    return _holdout(spark, d, k).select(F.lit(k).cast("bigint").alias("best_k"), _r6("r2"), "n")


_LAT = "SELECT id, floor(x1 * 2) / 2 AS x1, x2, y, is_test FROM ({})"


@register("knn_lattice", f"""WITH b AS ({_LAT.format(WIND_SQL)}),
    pts AS (SELECT x1, x2, count(*) AS n, sum(y) AS sum_y, min(id) AS pid FROM b WHERE NOT is_test GROUP BY x1, x2),
    pr AS (SELECT q.id AS qid, p.n, p.sum_y, row_number() OVER (PARTITION BY q.id ORDER BY
             (q.x1 - p.x1) * (q.x1 - p.x1) + (q.x2 - p.x2) * (q.x2 - p.x2), p.pid) AS rk
           FROM (SELECT * FROM b WHERE is_test) q CROSS JOIN pts p),
    c AS (SELECT *, sum(n) OVER (PARTITION BY qid ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
          FROM pr WHERE rk <= {K})
    SELECT qid AS test_id, round(sum(sum_y) / sum(n), 6) AS prediction FROM c WHERE cum - n < {K} GROUP BY qid""")
def knn_lattice(spark, d):
    e = wind_rows(spark, d).withColumn("x1", F.floor(F.col("x1") * 2) / 2)
    p = KNN.knn_lattice(e.filter(~F.col("is_test")), e.filter(F.col("is_test")), K)
    return p.select(F.col("qid").alias("test_id"), F.round("prediction", 6).alias("prediction"))


# ------------------------------------------------------------------ M6, M7, M9, E14
_FOLDS_SQL = f"""SELECT fold, role, event_id, idx FROM (SELECT fold, event_id, idx,
      CASE WHEN idx < n - (5 - fold) * (n // 6) THEN 'train'
           WHEN idx < n - (5 - fold) * (n // 6) + n // 6 THEN 'test' END AS role
    FROM (SELECT unnest([0, 1, 2, 3, 4]) AS fold, event_id, idx, n FROM
          (SELECT event_id, row_number() OVER (ORDER BY time, event_id) - 1 AS idx, count(*) OVER () AS n
           FROM ({E11_SQL})))) WHERE role IS NOT NULL"""


@register("ts_folds", _FOLDS_SQL)
def ts_folds(spark, d):
    f = EV.expanding_folds(training_set(spark, d), ["time", "event_id"], 5)
    return f.select("fold", "role", "event_id", "idx")


_TS_BASE = f"""SELECT f.fold AS g, f.role, w.event_id AS id, w.Speed AS x1, w.Angle AS x2, w.Energy AS y, w.time
    FROM ({_FOLDS_SQL}) f JOIN ({E11_SQL}) w ON w.event_id = f.event_id"""
_TS_PRED = f"""SELECT g, qid, avg(y) AS p FROM ({knn_sql(f"SELECT * FROM ({_TS_BASE}) WHERE role = 'train'",
    f"SELECT * FROM ({_TS_BASE}) WHERE role = 'test'", K, group=True)}) GROUP BY g, qid"""
_TVP_SQL = f"""SELECT a.g AS fold, a.qid, t.time, t.y AS truth, a.p AS prediction FROM ({_TS_PRED}) a
    JOIN (SELECT * FROM ({_TS_BASE}) WHERE role = 'test') t ON t.g = a.g AND t.id = a.qid"""


def _cv_report(spark, d):
    return W.e14_cv_report(training_set(spark, d), ["time", "event_id"], "event_id", K, "Energy", 5)


@register("truth_vs_pred", f"""SELECT fold, qid, time, round(truth, 6) AS truth, round(prediction, 6) AS prediction
    FROM ({_TVP_SQL})""")
def truth_vs_pred(spark, d):
    _, _, tvp = _cv_report(spark, d)
    return tvp.select("fold", "qid", "time", _r6("truth"), _r6("prediction"))


@register("cv_mae", f"""SELECT fold, round(avg(abs(truth - prediction)), 6) AS mae, count(*) AS n
    FROM ({_TVP_SQL}) GROUP BY fold""")
def cv_mae(spark, d):
    per_fold, _, _ = _cv_report(spark, d)
    return per_fold.select("fold", _r6("mae"), "n")


@register("e14_cv_report", f"""SELECT round(avg(mae), 6) AS mean_MAE, count(*) AS folds FROM
    (SELECT fold, avg(abs(truth - prediction)) AS mae FROM ({_TVP_SQL}) GROUP BY fold)""")
def e14_cv_report(spark, d):
    _, mean, _ = _cv_report(spark, d)
    return mean.select(_r6("mean_MAE"), "folds")


# ------------------------------------------------------------------ M8, K2-K6, M10, E12, E15
_FUTURE_SQL = f"""SELECT *, {ANGLE_SQL} AS Angle FROM ({FC_SQL}) WHERE time > TIMESTAMP '2024-01-25 00:00:00'"""
_NEWEST_SQL = f"""SELECT * FROM ({_FUTURE_SQL}) WHERE Source_time = (SELECT max(Source_time) FROM ({_FUTURE_SQL}))"""
_MODEL_SQL = f"SELECT event_id AS id, Speed AS x1, Angle AS x2, Energy AS y FROM ({E11_SQL})"


def _score_sql(queries_sql: str) -> str:
    q = f"SELECT event_id AS id, Speed AS x1, Angle AS x2 FROM ({queries_sql})"
    pred = f"SELECT qid, avg(y) AS p FROM ({knn_sql(_MODEL_SQL, q, K)}) GROUP BY qid"
    return f"SELECT f.*, a.p AS prediction FROM ({queries_sql}) f JOIN ({pred}) a ON a.qid = f.event_id"


def _model(spark, d):
    return training_set(spark, d)


@register("score_newest", f"""SELECT event_id, time, Direction, Speed, Angle, round(prediction, 6) AS prediction
    FROM ({_score_sql(_NEWEST_SQL)})""")
def score_newest(spark, d):
    fc = W.newest_forecast_features(S.forecasts(spark, d), AS_OF)
    out = W.score_forecasts(_model(spark, d), K, fc, "event_id")
    return out.select("event_id", "time", "Direction", "Speed", "Angle", _r6("prediction"))


RUN_K = (3, K, 7)  # neighbours of the three runs


def _saved_predictions(spark, d):
    """Three runs, each saving the scores of the whole future horizon under its own run stamp; read back.

    The runs differ in k, so one neighbour search serves all of them, and one write appends the runs.
    """
    path = scratch_path(spark, "predictions")
    fut = future_horizon(S.forecasts(spark, d), "time", AS_OF).withColumn("Angle", compass_angle("Direction"))
    every = KNN.knn_all_k(_model(spark, d), fut, max(RUN_K), features=W.FEATURES, train_id="event_id", test_id="event_id", y_col="Energy")
    stamp = F.coalesce(*[F.when(F.col("k") == k, ntz_lit(t)) for k, t in zip(RUN_K, STAMPS)])
    runs = every.filter(F.col("k").isin(*RUN_K)).select(F.col("qid").alias("event_id"), "prediction", stamp.alias("prediction_time"))
    SK.save_predictions(fut.join(runs, "event_id"), path, F.col("prediction_time"))
    return SK.load_predictions(spark, path)


_SAVED_SQL = f"""SELECT f.*, p.prediction, r.prediction_time, r.prediction_stamp FROM ({_FUTURE_SQL}) f
    JOIN (SELECT qid, k, avg(y) FILTER (rk <= k) AS prediction FROM ({knn_sql(_MODEL_SQL,
        f"SELECT event_id AS id, Speed AS x1, Angle AS x2 FROM ({_FUTURE_SQL})", max(RUN_K))}), (SELECT unnest({list(RUN_K)}) AS k) GROUP BY qid, k) p
      ON p.qid = f.event_id
    JOIN (VALUES {", ".join(f"({k}, TIMESTAMP '{t}', '{x}')" for k, t, x in zip(RUN_K, STAMPS, STAMP_TEXT))}) r(k, prediction_time, prediction_stamp) ON r.k = p.k"""


@register("save_load_predictions", f"""SELECT event_id, time, round(prediction, 6) AS prediction, prediction_time,
    prediction_stamp FROM ({_SAVED_SQL})""")
def save_load_predictions(spark, d):
    return _saved_predictions(spark, d).select("event_id", "time", _r6("prediction"), "prediction_time",
                                               "prediction_stamp")


_LATEST_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY time
    ORDER BY prediction_time DESC, event_id DESC) AS rn FROM ({_SAVED_SQL})) WHERE rn = 1"""


@register("latest_prediction", f"""SELECT time, event_id, round(prediction, 6) AS prediction, prediction_time
    FROM ({_LATEST_SQL})""")
def latest_prediction(spark, d):
    lp = latest_per_key(_saved_predictions(spark, d), "time", "prediction_time", tie="event_id")
    return lp.select("time", "event_id", _r6("prediction"), "prediction_time")


_ACTUAL_SQL = f"""SELECT time_bucket(INTERVAL 3 HOUR, time) AS time, avg(Total) AS Total FROM ({GEN_SQL})
    WHERE Total > 0 AND NOT isnan(Total) GROUP BY 1"""
_BACK_SQL = f"""SELECT l.time, l.event_id, l.prediction, a.Total, l.prediction - a.Total AS error,
    abs(l.prediction - a.Total) AS abs_error FROM ({_LATEST_SQL}) l JOIN ({_ACTUAL_SQL}) a ON a.time = l.time"""


def _backcheck(spark, d):
    return W.e15_backcheck(_saved_predictions(spark, d), S.generation(spark, d), tie="event_id")


@register("backcheck", f"""SELECT time, event_id, round(prediction, 6) AS prediction, round(Total, 6) AS Total,
    round(error, 6) AS error, round(abs_error, 6) AS abs_error FROM ({_BACK_SQL})""")
def backcheck(spark, d):
    rows, _ = _backcheck(spark, d)
    return rows.select("time", "event_id", _r6("prediction"), _r6("Total"), _r6("error"), _r6("abs_error"))


@register("e15_backcheck", f"""SELECT round(abs_error, 6) AS mae, round(CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot
    WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2, n FROM (SELECT avg(abs_error) AS abs_error,
    sum(error * error) AS ss_res, var_pop(Total) * count(Total) AS ss_tot, count(*) AS n FROM ({_BACK_SQL}))""")
def e15_backcheck(spark, d):
    _, summary = _backcheck(spark, d)
    return summary.select(_r6("mae"), _r6("r2"), "n")


@register("model_roundtrip", f"SELECT round(r2, 6) AS r2, n FROM ({holdout_sql(WIND_SQL, K)})")
def model_roundtrip(spark, d):
    tr, te = _parts(spark, d)
    path = scratch_path(spark, "model")
    SK.save_model(tr.select("id", "x1", "x2", "y"), K, path)
    rows, k = SK.load_model(spark, path)
    p = KNN.knn_predict(rows, te, k)
    truth = te.select(F.col("id").alias("qid"), "y")
    return EV.r2_score(p.join(truth, "qid"), "y", "prediction").select(_r6("r2"), "n")


def _e12(spark, d):
    """Grid search on the training part, chosen k, holdout R² (E12).

    The CV table is checkpointed: it feeds both the choice of k and the run
    log, and must not be recomputed for each."""
    rows = wind_rows(spark, d)
    tr, te = rows.filter(~F.col("is_test")), rows.filter(F.col("is_test"))
    cv = cut_lineage(W.grid_search_cv(tr, "id", "y", K_MAX, 5, SEED, XY))
    best = W.best_k(cv).first()
    k = int(best["k"])
    h = W.holdout_r2(tr, te, k, "id", "y", XY)
    return k, float(best["mean_r2"]), h, cv


@register("e12_model_selection", f"""SELECT b.k AS best_k, round(b.mean_r2, 6) AS cv_score FROM
    ({best_k_sql(WIND_SQL, K_MAX)}) b""")
def e12_model_selection(spark, d):
    rows = wind_rows(spark, d)
    cv = W.grid_search_cv(rows.filter(~F.col("is_test")), "id", "y", K_MAX, 5, SEED, XY)
    return W.best_k(cv).select(F.col("k").cast("bigint").alias("best_k"),
                               F.round("mean_r2", 6).alias("cv_score"))


RUN_AT = _dt.datetime(2024, 1, 11, 8, 30, 1)
_LOG_ROW = "SELECT 'run-1' AS run_id, '{kind}' AS kind, {key} AS key, {num} AS num_value, {text} AS str_value, TIMESTAMP '" + str(RUN_AT) + "' AS logged_at FROM {src}"


def _log_sql() -> str:
    best, hold = best_k_sql(WIND_SQL, K_MAX), holdout_all_sql(WIND_SQL, K_MAX)
    mae = f"SELECT avg(mae) AS v FROM (SELECT avg(abs(truth - prediction)) AS mae FROM ({_TVP_SQL}) GROUP BY fold)"
    param = lambda k, v, src="(SELECT 1)": _LOG_ROW.format(kind="param", key=f"'{k}'", num="CAST(NULL AS DOUBLE)", text=v, src=src)
    metric = lambda k, v, src: _LOG_ROW.format(kind="metric", key=k, num=f"round(CAST({v} AS DOUBLE), 6)", text="CAST(NULL AS VARCHAR)", src=src)
    return " UNION ALL ".join([
        param("model", "'KNN'"), param("Model method", "'grid search over k'"), param("days", f"'{HISTORY_DAYS}'"),
        param("prediction_time", f"'{STAMP_TEXT[-1]}'"), param("best_model", "'KNN(k=' || k || ')'", f"({best})"),
        metric("'KNN_neighbors'", "k", f"({best})"), metric("'CV_score'", "mean_r2", f"({best})"),
        metric("'Score'", "h.r2", f"({best}) b JOIN ({hold}) h ON h.k = b.k"), metric("'mean_MAE'", "v", f"({mae})"),
        metric("'cv_r2_k' || k", "mean_r2", f"({grid_cv_sql(WIND_SQL, K_MAX)})")])


@register("run_log", _log_sql())
def run_log(spark, d):
    """Log one run (parameters, CV score per k, chosen k, holdout R², mean MAE) and read it back."""
    path = scratch_path(spark, "runs")
    k, cv_score, h, cv = _e12(spark, d)
    _, mean, _ = _cv_report(spark, d)
    SK.log_run(spark, path, "run-1", {"model": "KNN", "Model method": "grid search over k", "best_model": f"KNN(k={k})", "days": HISTORY_DAYS,
                                      "prediction_time": STAMP_TEXT[-1]},
               {"KNN_neighbors": k, "CV_score": cv_score, "Score": h.first()["r2"], "mean_MAE": mean.first()["mean_MAE"]}, RUN_AT)
    SK.log_metric_frame(cv.withColumn("key", F.concat(F.lit("cv_r2_k"), F.col("k").cast("string"))),
                        path, "run-1", "key", "mean_r2", RUN_AT)
    return SK.read_runs(spark, path).withColumn("num_value", F.round("num_value", 6))


SEARCH_K = (1, K, 15)


@register("run_search", f"""SELECT 'run-' || (list_position({list(SEARCH_K)}, k) - 1) AS run_id, 'KNN' AS model, CAST(k AS DOUBLE) AS KNN_neighbors,
    round(r2, 6) AS Score FROM ({holdout_all_sql(WIND_SQL, max(SEARCH_K))}) WHERE list_contains({list(SEARCH_K)}, k)""")
def run_search(spark, d):
    """Three runs, one of them logged twice (the later value counts), as one row each."""
    path = scratch_path(spark, "runs")
    tr, te = _parts(spark, d)
    truth = te.select(F.col("id").alias("qid"), "y")
    every = cut_lineage(EV.r2_score(KNN.knn_all_k(tr, te, max(SEARCH_K)).join(truth, "qid"), "y", "prediction", ["k"]))
    score = {k: every.filter(F.col("k") == k).first()["r2"] for k in SEARCH_K}
    SK.log_run(spark, path, "run-1", {"model": "old"}, {"Score": -1.0}, RUN_AT - _dt.timedelta(days=1))
    for i, k in enumerate(SEARCH_K):
        SK.log_run(spark, path, f"run-{i}", {"model": "KNN"}, {"KNN_neighbors": k, "Score": score[k]}, RUN_AT)
    return SK.search_runs(spark, path, params=["model"], metrics=["KNN_neighbors", "Score"]).withColumn("Score", F.round("Score", 6))


# ------------------------------------------------------------------ streaming re-run, CSV history
@register("stream_score_forecasts", f"""SELECT event_id, time, Lead_hours, round(prediction, 6) AS prediction
    FROM ({_score_sql(_FUTURE_SQL)})""")
def stream_score_forecasts(spark, d):
    """Future forecasts land in three files; the run is repeated after two, after the third, and once more with nothing new."""
    from brisa.streaming import score_new_forecasts
    landing, ckpt, out = (scratch_path(spark, x) for x in ("landing", "stream-ckpt", "stream-predictions"))
    fut = future_horizon(S.forecasts(spark, d), "time", AS_OF)
    model_path = scratch_path(spark, "model")
    SK.save_model(_model(spark, d).select("event_id", "Speed", "Angle", "Energy"), K, model_path)
    for i, files in enumerate(((1, 3), (5,), ())):
        for lo in files:
            fut.filter(F.col("Lead_hours").between(lo, lo + 1)).coalesce(1).write.mode("append").parquet(landing)
        score_new_forecasts(spark, landing, fut.schema, model_path, out, ckpt, run_time=STAMPS[i])
    return SK.load_predictions(spark, out).select("event_id", "time", "Lead_hours", _r6("prediction"))


def _history(spark, d):
    """The saved runs as CSV files under their own column name, with an un-padded stamp; read back for the back-check."""
    path = scratch_path(spark, "prediction-csv")
    saved = _saved_predictions(spark, d)
    FS.write_csv(saved.select("event_id", F.col("time").cast("string").alias("time"), "Direction",
                              F.col("prediction").alias("Generated Power Prediction"),
                              stamp_text("prediction_time").alias("prediction_time")), path)
    return SK.load_prediction_csvs(spark, path, "event_id long, time string, Direction string, `Generated Power Prediction` double, "
                                   "prediction_time string", {"Generated Power Prediction": "prediction"})


@register("load_prediction_csv", f"""SELECT event_id, time, Direction, round(prediction, 6) AS prediction, prediction_time
    FROM ({_SAVED_SQL})""")
def load_prediction_csv(spark, d):
    return _history(spark, d).select("event_id", "time", "Direction", _r6("prediction"), "prediction_time")


@register("history_backcheck", ORACLE["e15_backcheck"])
def history_backcheck(spark, d):
    """The back-check fed from the CSV history."""
    _, summary = W.e15_backcheck(_history(spark, d), S.generation(spark, d), tie="event_id")
    return summary.select(_r6("mae"), _r6("r2"), "n")


_HOLES_SQL = f"""SELECT event_id, time, CASE WHEN event_id % 7 = 0 THEN 'XX' WHEN event_id % 11 = 0 THEN NULL ELSE Direction END AS Direction, Speed
    FROM ({_FUTURE_SQL})"""


@register("score_keeps_all", f"""SELECT h.event_id, h.Direction, round(s.prediction, 6) AS prediction FROM ({_HOLES_SQL}) h
    LEFT JOIN ({_score_sql(_FUTURE_SQL)}) s ON s.event_id = h.event_id AND coalesce(h.Direction, 'XX') <> 'XX'""")
def score_keeps_all(spark, d):
    """Forecasts with unknown and missing compass points keep their rows, without a prediction."""
    point = F.when(F.col("event_id") % 7 == 0, F.lit("XX")).when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("Direction"))
    fut = future_horizon(S.forecasts(spark, d), "time", AS_OF).withColumn("Direction", point)
    out = W.score_forecasts(_model(spark, d), K, fut.withColumn("Angle", compass_angle("Direction")), "event_id")
    return out.select("event_id", "Direction", _r6("prediction"))


@register("e14_metrics", f"""SELECT round(avg(a), 6) AS "mean_MAE", round(avg(b), 6) AS "mean_RMSE", round(avg(c), 6) AS "mean_MaxError" FROM
    (SELECT avg(abs(truth - prediction)) AS a, sqrt(avg((truth - prediction) * (truth - prediction))) AS b, max(abs(truth - prediction)) AS c
     FROM ({_TVP_SQL}) GROUP BY fold)""")
def e14_metrics(spark, d):
    """The report's metric list, logged and read back as a run."""
    path = scratch_path(spark, "runs")
    _, _, tvp = _cv_report(spark, d)
    _, mean = W.cv_metrics(tvp)
    W.log_cv(mean, path, "cv", RUN_AT)
    names = [f"mean_{n}" for n in W.METRICS]
    return SK.search_runs(spark, path, metrics=names).select(*[_r6(n) for n in names])


@register("e12_model_job", f"""SELECT b.k AS best_k, round(b.mean_r2, 6) AS cv_score, round(h.r2, 6) AS r2, round(h.r2, 6) AS r2_reloaded,
    (SELECT count(*) FROM ({_NEWEST_SQL})) AS scored, 'KNN(k=' || b.k || ')' AS best_model
    FROM ({best_k_sql(WIND_SQL, K_MAX)}) b JOIN ({holdout_all_sql(WIND_SQL, K_MAX)}) h ON h.k = b.k""")
def e12_model_job(spark, d):
    """The whole model job; its run, predictions and model are read back from what it wrote."""
    from brisa.plans.jobs import model_job
    folder = scratch_path(spark, "model-job")
    rows = training_set(spark, d).select("event_id", "Speed", "Angle", "Energy")
    got = model_job(spark, rows, W.newest_forecast_features(S.forecasts(spark, d), AS_OF), "event_id", folder, "run-1", RUN_AT, seed=SEED)
    runs = SK.search_runs(spark, f"{folder}/runs", ["best_model"], ["KNN_neighbors", "CV_score", "Score"])
    scored = F.lit(SK.load_predictions(spark, f"{folder}/predictions").count()).alias("scored")
    return runs.select(F.col("KNN_neighbors").cast("bigint").alias("best_k"), F.round("CV_score", 6).alias("cv_score"), F.round("Score", 6).alias("r2"),
                      F.round(F.lit(got["r2_reloaded"]), 6).alias("r2_reloaded"), scored, "best_model")
