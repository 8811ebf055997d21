"""Sinks: stamped predictions, the run log, the KNN model store.

All writes go from the executors to a (shared) folder.  A run that is saved again
replaces itself; prediction tables are partitioned by date, so reading recent
predictions prunes partitions.  Models and compacted logs are versions that one small
file publishes (``versions``): readers see the old one or the new one.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions.stamps import STAMP_PATTERN, ntz_lit, parse_stamp, stamp_text
from brisa.sources import versions as VS
from brisa.sources.files import read_csv

RUN_LOG_SCHEMA = ("run_id string, kind string, key string, num_value double, str_value string, "
                  "logged_at timestamp_ntz")


def save_predictions(df: DataFrame, path: str, stamp: _dt.datetime | Column, run: str | Column | None = None) -> None:
    """Save predictions with their run time (``prediction_time``; one stamp, or a column of ``df``), its
    un-padded text form, and the ``run`` they belong to (default: the text stamp).

    Partitioned by ``prediction_date`` and ``run``; a save replaces the runs it holds, so a retried run
    has its rows once, and leaves all others alone.  A run has one date.
    """
    ts = stamp if isinstance(stamp, Column) else ntz_lit(stamp)
    key = stamp_text(ts) if run is None else run if isinstance(run, Column) else F.lit(run)
    (df.withColumn("prediction_time", ts)
       .withColumn("prediction_stamp", stamp_text(ts))
       .withColumn("prediction_date", F.to_date(ts))
       .withColumn("run", key)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prediction_date", "run").parquet(path))


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Every saved prediction run, as one table."""
    return spark.read.parquet(path)


def load_prediction_csvs(spark: SparkSession, path: str, schema: str, rename: dict[str, str] | None = None,
                         time_col: str = "time") -> DataFrame:
    """Prediction CSV files (one per run) with ``prediction_time`` as stamp text.

    Read as they are written (``files.write_csv``: quoted, nulls marked); a header that differs from the
    schema or a bad value fails.  ``rename`` maps file columns to the names the back-check takes
    (``prediction``); ``time_col`` is parsed if it is text.
    """
    df = read_csv(spark, path, schema, enforceSchema="false")
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    if dict(df.dtypes).get(time_col) == "string":
        df = df.withColumn(time_col, F.to_timestamp_ntz(time_col))
    return df.withColumn("prediction_time", parse_stamp("prediction_time"))


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict,
            at: _dt.datetime) -> None:
    """Append one run's parameters and scalar metrics as long rows."""
    rows = [(run_id, "param", k, None, str(v), at) for k, v in params.items()]
    rows += [(run_id, "metric", k, float(v) if v is not None else None, None, at)
             for k, v in metrics.items()]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).write.mode("append").parquet(path)


def log_metric_frame(df: DataFrame, path: str, run_id: str, key_col: str, value_col: str,
                     at: _dt.datetime) -> None:
    """Append metrics computed as a DataFrame (e.g. a score per k) directly
    from the executors."""
    (df.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
               F.col(key_col).cast("string").alias("key"),
               F.col(value_col).cast("double").alias("num_value"),
               F.lit(None).cast("string").alias("str_value"),
               ntz_lit(at).alias("logged_at"))
       .write.mode("append").parquet(path))


#: Most keys that ``search_runs`` makes columns of by itself.
MOST_KEYS = 1000


def log_rows(df: DataFrame, path: str) -> None:
    """Append long rows of many runs (the columns of ``RUN_LOG_SCHEMA``; those missing are null), from the executors."""
    have = set(df.columns)
    names = [c.rsplit(" ", 1) for c in RUN_LOG_SCHEMA.split(", ")]
    df.select(*[(F.col(n) if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in names]).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The log: what ``compact_runs`` has folded, and the files logged since."""
    base, log = VS.current(spark, path), spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return log if base is None else spark.read.schema(RUN_LOG_SCHEMA).parquet(base).unionByName(log)


def _latest_values(log: DataFrame) -> DataFrame:
    """One row for each run, kind and key: the value logged last (of equal times the greater value)."""
    newest = F.max(F.struct("logged_at", "num_value", "str_value")).alias("v")
    return log.groupBy("run_id", "kind", "key").agg(newest).select("run_id", "kind", "key", "v.num_value", "v.str_value", "v.logged_at")


def compact_runs(spark: SparkSession, path: str, files: int = 1) -> int:
    """Fold the log's small files into ``files`` files of the latest values; returns how many files were folded.

    Searches give the same before, during and after: the folded version is published whole, then the files
    that were read for it go.  Until they have gone, values are in both, and the latest value is the same.
    """
    old = [f for f in VS.files(spark, path) if f.endswith(".parquet")]
    if not old:
        return 0
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(*[f"{path}/{f}" for f in old])
    base = VS.current(spark, path)
    if base is not None:
        log = log.unionByName(spark.read.schema(RUN_LOG_SCHEMA).parquet(base))
    folder = VS.begin(spark, path)
    _latest_values(log).coalesce(files).write.parquet(folder)
    VS.publish(spark, path, folder)
    for f in old:
        VS.remove(spark, f"{path}/{f}")
    VS.expire(spark, path, keep=2)  # a reader that began before may still read the last one
    return len(old)


def run_keys(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of all params and of all metrics in the log, sorted."""
    found = read_runs(spark, path).select("kind", "key").distinct().orderBy("kind", "key").take(MOST_KEYS + 1)
    if len(found) > MOST_KEYS:
        raise ValueError(f"the log has more than {MOST_KEYS} keys: name the ones to search")
    return [r.key for r in found if r.kind == "param"], [r.key for r in found if r.kind == "metric"]


def search_runs(spark: SparkSession, path: str, params: list[str] | None = None, metrics: list[str] | None = None) -> DataFrame:
    """One row per run: a text column for each of ``params``, a number for each of ``metrics``.

    A key logged more than once has its latest value.  With neither list given, the log's own keys are the
    columns; there, a metric called like a param (or ``run_id``) is ``metric_<name>``."""
    def latest(kind: str, key: str, value: str, name: str) -> Column:
        mine = (F.col("kind") == kind) & (F.col("key") == key)
        return F.max_by(value, F.when(mine, F.col("logged_at"))).alias(name)

    if params is None and metrics is None:
        params, metrics = run_keys(spark, path)
    params, metrics = list(params or ()), list(metrics or ())
    taken = {"run_id", *params}
    cols = [latest("param", k, "str_value", k if k != "run_id" else "param_run_id") for k in params]
    cols += [latest("metric", k, "num_value", f"metric_{k}" if k in taken else k) for k in metrics]
    return read_runs(spark, path).groupBy("run_id").agg(*cols) if cols else read_runs(spark, path).select("run_id").distinct()


def save_model(rows: DataFrame, k: int, path: str, keep: int = 2) -> str:
    """Save a KNN model, its training rows and ``k``, as the current version under ``path``; returns its folder.

    Both parts are written before the version is published.  The last ``keep`` versions stay.
    """
    spark = rows.sparkSession
    folder = VS.begin(spark, path)
    rows.write.parquet(f"{folder}/rows")
    spark.createDataFrame([(int(k),)], "k int").coalesce(1).write.parquet(f"{folder}/params")
    VS.publish(spark, path, folder)
    VS.expire(spark, path, keep)
    return folder


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Rows and ``k`` of the current version."""
    folder = VS.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no model is published under {path}")
    k = spark.read.parquet(f"{folder}/params").first()["k"]
    return spark.read.parquet(f"{folder}/rows"), int(k)


__all__ = ["STAMP_PATTERN", "RUN_LOG_SCHEMA", "save_predictions", "load_predictions",
           "load_prediction_csvs", "log_run", "log_metric_frame", "log_rows", "read_runs", "compact_runs", "run_keys", "search_runs",
           "save_model", "load_model"]
