"""Time-series operators on an ordinary timestamp column (no index).

Tumbling bins use ``window()``: left-closed, labelled by the bin start and
aligned to the epoch (so 3-hour bins start at midnight).  Aggregation is
partial per task then final per bin - a hot bin costs one row per task in
the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions.stamps import ntz_lit


def positive_values(df: DataFrame, col: str, threshold: float = 0.0) -> DataFrame:
    """``col > threshold``; NaN is dropped too (Spark orders NaN above numbers)."""
    return df.filter((F.col(col) > F.lit(threshold)) & ~F.isnan(F.col(col)))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """pandas ``dropna()``: drops rows with a null or NaN in any (given) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def bin_start(time_col: str, every: str = "3 hours"):
    return F.window(F.col(time_col), every).start


def resample_mean(df: DataFrame, time_col: str, value_cols: Sequence[str],
                  every: str = "3 hours", out_time: str = "time") -> DataFrame:
    """Mean of each value column per tumbling bin; bins without rows are absent."""
    return df.groupBy(bin_start(time_col, every).alias(out_time)).agg(
        *[F.avg(c).alias(c) for c in value_cols])


def resample_fill(df: DataFrame, time_col: str, value_cols: Sequence[str],
                  every_minutes: int = 180, out_time: str = "time") -> DataFrame:
    """Like :func:`resample_mean` but every bin between the first and the last
    is present (empty bins have null means), as pandas ``resample`` emits.

    The bin grid is generated with ``spark.range`` over the bin count, so it
    is distributed; only the two bounds are read on the driver.
    """
    every = f"{every_minutes} minutes"
    means = resample_mean(df, time_col, value_cols, every, out_time)
    bounds = means.agg(F.min(out_time).alias("lo"), F.max(out_time).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return means
    lo, hi = bounds["lo"], bounds["hi"]
    n = int((hi - lo) / _dt.timedelta(minutes=every_minutes)) + 1
    spark = df.sparkSession
    grid = spark.range(n).select(
        (ntz_lit(lo) + F.make_dt_interval(
            F.lit(0), F.lit(0), (F.col("id") * every_minutes).cast("int"))).alias(out_time))
    return grid.join(means, out_time, "left")


def hourly_mean(df: DataFrame, time_col: str, value_col: str,
                out_col: str = "Total_Average") -> DataFrame:
    """Mean by (calendar date, hour of day)."""
    return df.groupBy(F.to_date(time_col).alias("Date"), F.hour(time_col).alias("Hour")).agg(
        F.avg(value_col).alias(out_col))


def time_join(bins: DataFrame, forecasts: DataFrame, on: str = "time") -> DataFrame:
    """Inner equi-join on the bin start; several forecasts per bin are all kept."""
    return bins.join(forecasts, on, "inner")


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   tie: str | None = None) -> DataFrame:
    """The newest row per key (``row_number() ... = 1``).

    Planned as a ``WindowGroupLimit`` (limit 1) before the shuffle, so each
    task sends at most one row per key; a hot key stays cheap.
    """
    from pyspark.sql import Window
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(order_col).desc()] + ([F.col(tie).desc()] if tie else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
