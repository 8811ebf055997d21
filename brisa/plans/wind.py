"""Named wind-power analyses (E11-E15) over Generation / MetForecasts shapes.

* generation: ``time, Total`` (+ other measures, dropped)
* forecasts:  ``time, Direction, Lead_hours, Source_time, Speed`` (+ an id)

Everything is one lazy plan per result, except where a scalar decision
is needed to shape the next job (the chosen ``k``), which is read as one
value.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions.compass import compass_angle
from brisa.operators import evaluate as EV
from brisa.operators import knn as KNN
from brisa.operators.relational import newest_rows
from brisa.operators.timeseries import (
    drop_any_null,
    hourly_mean,
    latest_per_key,
    positive_values,
    resample_mean,
    time_join,
)
from brisa.session import cut_lineage
from brisa.sources.sinks import log_metric_frame
from brisa.sources.scans import bounded_history, future_horizon, trailing_window

FEATURES = ("Speed", "Angle")


def e11_training_set(generation: DataFrame, forecasts: DataFrame, as_of, days: int,
                     lead: int = 1, every: str = "3 hours", strict_compass: bool = False) -> DataFrame:
    """Clean -> 3-hour mean -> angle -> time join -> finalise.

    Output: ``time, Energy, Direction, Lead_hours, Source_time, Speed, Angle``
    (+ forecast columns), rows with any null removed.
    """
    gen = positive_values(trailing_window(generation, "time", as_of, days), "Total")
    energy = resample_mean(gen.select("time", "Total"), "time", ["Total"], every)
    wind = drop_any_null(bounded_history(forecasts, "time", as_of, days, "Lead_hours", lead))
    wind = wind.withColumn("Angle", compass_angle("Direction", strict=strict_compass))
    data = time_join(energy, wind).withColumnRenamed("Total", "Energy")
    return drop_any_null(data)


def e13_hourly_actuals(generation: DataFrame, as_of, days: int = 3) -> DataFrame:
    gen = positive_values(trailing_window(generation, "time", as_of, days), "Total")
    return hourly_mean(gen, "time", "Total", "Total_Average")


def newest_forecast_features(forecasts: DataFrame, as_of) -> DataFrame:
    """Future forecasts of the newest source run, with their angle."""
    fut = newest_rows(future_horizon(forecasts, "time", as_of), "Source_time")
    return fut.withColumn("Angle", compass_angle("Direction"))


def score_forecasts(model_rows: DataFrame, k: int, forecast_rows: DataFrame, id_col: str,
                    target: str = "Energy", strict: bool = False) -> DataFrame:
    """Attach ``prediction`` (KNN mean of ``target``) to each forecast row.

    Every row stays: one whose features are missing (an unknown compass
    point, a null, NaN or infinite speed) has a null prediction.  ``strict``
    raises instead, when the plan runs.
    """
    if strict:
        forecast_rows = forecast_rows.withColumn(FEATURES[0], F.when(_unusable(), F.raise_error(F.lit("forecast without usable features"))
                                                                     .cast("double")).otherwise(F.col(FEATURES[0])))
    pred = KNN.knn_predict(model_rows, forecast_rows, k, features=FEATURES, train_id=id_col,
                           test_id=id_col, y_col=target)
    return forecast_rows.join(pred.select(F.col("qid").alias(id_col), "prediction"), id_col, "left")


def unusable_forecasts(forecast_rows: DataFrame) -> DataFrame:
    """``n``: forecast rows that no model can score (a feature is missing or not finite)."""
    return forecast_rows.agg(F.count_if(_unusable()).alias("n"))


def _unusable():
    """Whether a feature is null, NaN or infinite."""
    return ~F.expr(" AND ".join(f"coalesce(abs({c}) < double('infinity'), false)" for c in FEATURES))


def grid_search_cv(train: DataFrame, id_col: str, target: str = "Energy", k_max: int = 99,
                   n_folds: int = 5, seed: str = "420",
                   features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean R² over ``n_folds`` hash folds for every k in 1..k_max, one job.

    Each row is a query in its own fold and may take rows of every other
    fold; the rows are indexed once and the neighbour search runs once for
    all folds and all k.  Output ``(k, mean_r2, folds)``; a k larger than
    the training part of a fold has no score there (see ``folds``).
    """
    f = cut_lineage(KNN.hash_fold(train, id_col, n_folds, seed))  # read as training rows, as queries and as truth
    preds = KNN.knn_curves(f, f, k_max, features=features, train_id=id_col, test_id=id_col, y_col=target,
                           tag_col="fold", admit="other")
    truth = f.select(F.col(id_col).alias("qid"), F.col(target).cast("double").alias("y"))
    scored = preds.join(truth, "qid").select("g", "y", F.posexplode("curve").alias("k", "prediction")).withColumn("k", F.col("k") + 1)
    per_fold = EV.r2_score(scored, "y", "prediction", ["g", "k"])
    return per_fold.groupBy("k").agg(F.avg("r2").alias("mean_r2"), F.count(F.lit(1)).alias("folds"))


def best_k(cv: DataFrame, n_folds: int = 5) -> DataFrame:
    """Highest mean score among the k scored on every fold; the smaller k wins a tie."""
    return cv.filter(F.col("folds") == n_folds).orderBy(F.col("mean_r2").desc(), F.col("k").asc()).limit(1)


def holdout_r2(train: DataFrame, test: DataFrame, k: int, id_col: str,
               target: str = "Energy", features: Sequence[str] = FEATURES) -> DataFrame:
    pred = KNN.knn_predict(train, test, k, features=features, train_id=id_col, test_id=id_col,
                           y_col=target)
    truth = test.select(F.col(id_col).alias("qid"), F.col(target).cast("double").alias("y"))
    return EV.r2_score(pred.join(truth, "qid"), "y", "prediction")


# name -> aggregate over (truth, prediction) columns
METRICS = {
    "MAE": lambda y, p: F.avg(F.abs(y - p)),
    "RMSE": lambda y, p: F.sqrt(F.avg((y - p) * (y - p))),
    "MaxError": lambda y, p: F.max(F.abs(y - p)),
}


def cv_metrics(tvp: DataFrame, metrics: dict = METRICS) -> tuple[DataFrame, DataFrame]:
    """Any list of metrics over (fold, truth, prediction): one row per fold, and the ``mean_<metric>`` row."""
    y, p = F.col("truth"), F.col("prediction")
    per_fold = tvp.groupBy("fold").agg(*[f(y, p).alias(n) for n, f in metrics.items()], F.count(F.lit(1)).alias("n"))
    return per_fold, per_fold.agg(*[F.avg(n).alias(f"mean_{n}") for n in metrics], F.count(F.lit(1)).alias("folds"))


def log_cv(mean: DataFrame, path: str, run_id: str, at) -> None:
    """Append the ``mean_<metric>`` values to the run log, from the executors."""
    names = [c for c in mean.columns if c.startswith("mean_")]
    rows = mean.select(F.explode(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names])).alias("m")).select("m.*")
    log_metric_frame(rows, path, run_id, "key", "value", at)


def e14_cv_report(series: DataFrame, order: Sequence[str], id_col: str, k: int,
                  target: str = "Energy", n_splits: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Expanding-window CV of KNN(k): (per-fold MAE, mean MAE, truth vs prediction)."""
    folds = cut_lineage(EV.expanding_folds(series, order, n_splits))
    # a row trains in every fold from its first one on, so one copy with that fold's number serves all
    tr = folds.filter(F.col("role") == "train").groupBy(id_col, *FEATURES, target).agg(F.min("fold").alias("fold"))
    te = folds.filter(F.col("role") == "test")
    pred = KNN.knn_predict(tr, te, k, features=FEATURES, train_id=id_col, test_id=id_col,
                           y_col=target, tag_col="fold", admit="upto")
    truth = te.select(F.col("fold").alias("g"), F.col(id_col).alias("qid"), "time",
                      F.col(target).cast("double").alias("truth"))
    tvp = truth.join(pred, ["g", "qid"]).withColumnRenamed("g", "fold")
    per_fold = EV.mae(tvp, "truth", "prediction", ["fold"])
    mean = per_fold.agg(F.avg("mae").alias("mean_MAE"), F.count(F.lit(1)).alias("folds"))
    return per_fold, mean, tvp


def latest_predictions(saved: DataFrame, key: str = "time", tie: str | None = None) -> DataFrame:
    """Newest saved prediction per valid time (by ``prediction_time``, then the greatest ``tie``)."""
    return latest_per_key(saved, key, "prediction_time", tie=tie)


def e15_backcheck(saved: DataFrame, generation: DataFrame, every: str = "3 hours",
                  tie: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest prediction per valid time vs the 3-hour actual mean:
    (row-level errors, summary MAE / R²)."""
    latest = latest_predictions(saved, tie=tie)
    actual = resample_mean(positive_values(generation, "Total").select("time", "Total"), "time",
                           ["Total"], every)
    rows = EV.error_columns(latest.join(actual, "time"), "Total", "prediction")
    return rows, EV.summary_scores(rows, "Total", "prediction")
