"""Whole jobs from files to results, on the shapes the original jobs read.

``review_job`` ingests the review, business and user JSON lines once and returns the
named analyses E1-E10 over the ingested tables.  ``model_job`` runs E12 from a training set to saved
predictions and a logged run.  Schemas are given, so no file is read to infer
one.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions import lexicon as LX
from brisa.functions.stamps import stamp_text
from brisa.operators import knn as KNN
from brisa.plans import reviews as E
from brisa.plans import wind as W
from brisa.session import cut_lineage, scratch_path
from brisa.sources import ingest as IN
from brisa.sources import sinks as SK

# Columns of the input files.
REVIEW = "review_id string, user_id string, business_id string, stars double, useful long, funny long, cool long, text string, date string"
BUSINESS = ("business_id string, name string, address string, city string, state string, postal_code string, latitude double, "
            "longitude double, stars double, review_count long, is_open long, categories string")
USER = "user_id string, name string, review_count long, average_stars double"
GENERATION = "time timestamp_ntz, ANM double, `Non-ANM` double, Total double"
FORECASTS = "time timestamp_ntz, Direction string, Lead_hours int, Source_time long, Speed double"
PREDICTIONS = ("time string, Direction string, Lead_hours int, Source_time long, Speed double, Angle double, "
               "`Generated Power Prediction` double, prediction_time string")


def review_job(spark: SparkSession, review: str, business: str, user: str, *, store: str | None = None, min_reviews: int = 1000, influencer_reviews: int = 1000,
               word: str = "authentic", top_word: str = "legitimate", terms=("authentic", "accent"), auth=("authentic", "legitimate"),
               neg=tuple(LX.NEGATIVE_WORDS), marker: str = LX.RESTAURANT_MARKER, drop=(LX.DROPPED_CATEGORY,),
               cuisines=tuple(LX.CUISINE_TYPES), groups: dict | None = None, sep: str = LX.CATEGORY_SEPARATOR,
               state: str = "AZ", cuisine: str = "Mexican") -> dict[str, DataFrame]:
    """E1-E10 from three JSON-lines paths, as lazy DataFrames by name.

    Each file is parsed once, into ``store`` (default: a scratch folder); the analyses read Parquet.  Lines that are no
    rows are in ``quarantine`` (input, line, file), their numbers in ``ingest`` (input, n_rows, n_quarantined).
    """
    store = store or scratch_path(spark, "review-job")
    taken = {n: IN.ingest_jsonl(spark, p, s, f"{store}/{n}", required=(key,))
             for n, p, s, key in (("review", review, REVIEW, "review_id"), ("business", business, BUSINESS, "business_id"), ("user", user, USER, "user_id"))}
    r, b, u = (taken[n].rows() for n in ("review", "business", "user"))
    named = lambda frame: functools.reduce(DataFrame.unionByName, [frame(t).withColumn("input", F.lit(n)) for n, t in taken.items()])
    influencers = E.e3_influencers(u, influencer_reviews)
    lex = dict(auth=auth, neg=neg, marker=marker, drop=drop, sep=sep)
    return {
        "e1_total_reviews": E.e1_total_reviews(b),
        "e2_top_rated": E.e2_top_rated(b, 5, min_reviews),
        "e3_influencers": influencers,
        "e4_influencer_businesses": E.e4_influencer_businesses(r, b, influencers),
        "e5_users_by_stars": E.e5_users_by_stored_stars(u),
        "e6_word_share": E.e6_word_share(r, word),
        "e7_top_categories": E.e7_top_categories(r, b, top_word, 40, sep),
        "e7_cuisine_counts": E.e7_cuisine_counts(r, b, top_word, cuisines, sep).orderBy(F.col("n").desc(), "category"),
        "e8_place_share": E.e8_place_share(r, b, terms).orderBy(F.col("ratio").desc_nulls_last(), "state", "city", "gid"),
        "e9_top_negative": E.e9_top_categories(r, b, "literal", 40, **lex),
        "e9_top_nonnegative": E.e9_top_categories(r, b, "complement_literal", 40, **lex),
        "e9_region_ratio": E.e9_region_ratio(r, b, True, groups, **lex),
        "e10_good_reviews": E.e10_good_reviews(r, b, state, cuisine, 5),
        "quarantine": named(IN.Ingested.quarantine).select("input", "line", "file"),
        "ingest": named(IN.Ingested.counts).select("input", "n_rows", "n_quarantined"),
    }


def model_job(spark: SparkSession, training: DataFrame, forecasts: DataFrame, id_col: str, folder: str, run_id: str, at: _dt.datetime,
              *, k_max: int = 99, seed: str = "420", days: int = 365) -> dict:
    """E12: choose k by cross-validation, score the holdout, refit on all rows, save the model, score the
    newest forecasts with the reloaded model, append them, and log the run.

    ``training``: id, Speed, Angle, Energy; ``forecasts``: id, Speed, Angle and what else shall be saved.
    Writes ``model``, ``predictions`` and ``runs`` under ``folder``.  Returns k, cv_score, r2 (holdout) and
    r2_reloaded (the same holdout, by a model saved and read back).
    """
    rows = cut_lineage(KNN.hash_split(training, id_col, seed))
    train, test = rows.filter(~F.col("is_test")).drop("is_test"), rows.filter(F.col("is_test")).drop("is_test")
    cv = cut_lineage(W.grid_search_cv(train, id_col, k_max=k_max, seed=seed))
    best = W.best_k(cv).first()
    if best is None:
        raise ValueError("no k was scored on every fold: too few training rows")
    k = int(best["k"])
    r2 = W.holdout_r2(train, test, k, id_col).first()["r2"]
    SK.save_model(train, k, f"{folder}/candidate")
    kept, kept_k = SK.load_model(spark, f"{folder}/candidate")
    r2_again = W.holdout_r2(kept, test, kept_k, id_col).first()["r2"]
    SK.save_model(rows.drop("is_test"), k, f"{folder}/model")
    model, k = SK.load_model(spark, f"{folder}/model")
    SK.save_predictions(W.score_forecasts(model, k, forecasts, id_col), f"{folder}/predictions", at)
    stamp = spark.range(1).select(stamp_text(F.lit(at).cast("timestamp_ntz"))).first()[0]
    SK.log_run(spark, f"{folder}/runs", run_id,
               {"model": "KNN", "Model method": "grid search over k", "best_model": f"KNN(k={k})", "days": days, "prediction_time": stamp},
               {"KNN_neighbors": k, "CV_score": best["mean_r2"], "Score": r2}, at)
    SK.log_metric_frame(cv.withColumn("key", F.concat(F.lit("cv_r2_k"), F.col("k").cast("string"))), f"{folder}/runs", run_id, "key", "mean_r2", at)
    return {"k": k, "cv_score": float(best["mean_r2"]), "r2": r2, "r2_reloaded": r2_again}
