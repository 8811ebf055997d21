"""Scores and time-ordered cross-validation folds.

Scores are aggregates (one pass, grouped by fold / k).  Ordered folds
need a global row number; it is computed without a single-partition
window: sort (range partitioned), number rows inside each partition,
add the row counts of the earlier partitions.  The sorted data is
checkpointed first so both uses see the same partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.session import checkpoint_dir, cut_lineage


def r2_score(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Coefficient of determination per group.

    Constant truth: 1.0 for a perfect fit, else 0.0 (scikit-learn's
    ``force_finite`` behaviour).
    """
    res = F.sum((F.col(y) - F.col(p)) * (F.col(y) - F.col(p)))
    tot = F.var_pop(F.col(y)) * F.count(F.col(y))
    g = df.groupBy(*by).agg(res.alias("ss_res"), tot.alias("ss_tot"), F.count(F.lit(1)).alias("n"))
    return g.select(*by, _r2_expr(F.col("ss_res"), F.col("ss_tot")).alias("r2"), "n")


def _r2_expr(ss_res: Column, ss_tot: Column) -> Column:
    return (F.when(ss_tot > 0, 1 - ss_res / ss_tot)
            .when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def summary_scores(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, R² and row count in one aggregate."""
    err = F.col(y) - F.col(p)
    g = df.groupBy(*by).agg(F.avg(F.abs(err)).alias("mae"), F.sum(err * err).alias("__res"),
                            (F.var_pop(F.col(y)) * F.count(F.col(y))).alias("__tot"),
                            F.count(F.lit(1)).alias("n"))
    return g.select(*by, "mae", _r2_expr(F.col("__res"), F.col("__tot")).alias("r2"), "n")


def mae(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"),
                               F.count(F.lit(1)).alias("n"))


def row_index(df: DataFrame, order: Sequence[str], key: Sequence[str] = (),
              out_col: str = "idx", count_col: str | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (within ``key`` if given).

    Distributed: ``orderBy`` range-partitions the rows; inside a partition
    ``monotonically_increasing_id`` counts rows; partition offsets are the
    cumulative row counts of earlier partitions (one row per partition, so
    the broadcast is bounded by the partition count, not the data).  A hot
    key is spread over many range partitions like any other rows.
    ``count_col`` adds the number of rows (of the key, or in total).
    """
    checkpoint_dir(df.sparkSession)
    keys, order = list(key), list(order)
    s = cut_lineage(df.orderBy(*(keys + order))
                    .withColumn("__pid", F.spark_partition_id())
                    .withColumn("__mid", F.monotonically_increasing_id()))
    if keys:
        return _keyed_index(s, keys, out_col, count_col)
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    sizes = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"),
                           F.sum("__c").over(every).alias("__total"))
    out = s.join(F.broadcast(offsets), "__pid").withColumn(out_col, F.col("__off") + pos)
    if count_col:
        out = out.withColumn(count_col, F.col("__total"))
    return out.drop("__pid", "__mid", "__off", "__total")


def _keyed_index(s: DataFrame, keys: list[str], out_col: str, count_col: str | None) -> DataFrame:
    """Positions within each key from counts per (partition, key): a hot key's rows stay in their partitions."""
    parts = s.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__c"), F.min("__mid").alias("__first"))
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0))).withColumn("__n", F.sum("__c").over(of_key))
    on = s["__pid"] == parts["__pid"]
    for k in keys:
        on &= s[k].eqNullSafe(parts[k])
    out = s.join(parts, on).select(s["*"], "__off", "__first", "__n")
    out = out.withColumn(out_col, F.col("__off") + F.col("__mid") - F.col("__first"))
    if count_col:
        out = out.withColumn(count_col, F.col("__n"))
    return out.drop("__pid", "__mid", "__off", "__first", "__n") if count_col != "__n" else out.drop("__pid", "__mid", "__off", "__first")


def expanding_folds(df: DataFrame, order: Sequence[str], n_splits: int = 5,
                    key: Sequence[str] = (), idx_col: str = "idx") -> DataFrame:
    """Expanding-window time-series folds (``TimeSeriesSplit`` arithmetic).

    With ``n`` rows and ``t = n div (n_splits + 1)``, fold ``i`` tests rows
    ``[n - (n_splits - i) * t, + t)`` and trains on every earlier row.  Output
    has one row per (fold, row) with ``role`` = ``train`` / ``test``; a row
    appears once per fold it belongs to.
    """
    keys = list(key)
    x = row_index(df, order, keys, idx_col, count_col="__n")
    t = F.floor(F.col("__n") / (n_splits + 1))
    folds = F.array(*[F.lit(i) for i in range(n_splits)])
    x = x.withColumn("fold", F.explode(folds))
    start = F.col("__n") - (F.lit(n_splits) - F.col("fold")) * t
    role = (F.when(F.col(idx_col) < start, F.lit("train"))
            .when(F.col(idx_col) < start + t, F.lit("test")))
    return x.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__n")


def error_columns(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.withColumn("error", F.col(p) - F.col(y)).withColumn("abs_error", F.abs(F.col("error")))
