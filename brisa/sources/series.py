"""Date-partitioned time series: a writer, and scans that read only the days they need.

A series table has one folder for each day (``day=2024-01-25``).  A load
replaces the days it holds and leaves the others alone, so a load that is run
again adds no rows.  Scans derive the bounds of the partition column from the
bounds of the time column; both reach the reader, one as partition filter and
the other as pushed filter, so a day outside the window is never listed, opened
or read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions.stamps import ntz_lit
from brisa.sources import scans as SC

DAY = "day"


def write_series(df: DataFrame, path: str, time_col: str = "time", files_per_task: int | None = None) -> None:
    """Write the rows under the days they fall on; those days' earlier rows are replaced.

    Rows without a time have no day and are left out (``missing_times`` counts them).  Rows are
    dealt out by ranges of (day, time): a task writes whole days or a run of one, so a day that holds
    most of the rows is written by many tasks, and a small day makes one file.
    """
    rows = df.where(F.col(time_col).isNotNull()).withColumn(DAY, F.to_date(time_col))
    n = [files_per_task] if files_per_task else []
    (rows.repartitionByRange(*n, DAY, time_col).sortWithinPartitions(DAY, time_col)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))


def missing_times(df: DataFrame, time_col: str = "time") -> DataFrame:
    """``n``: rows that ``write_series`` leaves out."""
    return df.agg(F.count_if(F.col(time_col).isNull()).alias("n"))


def read_series(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The whole series with its ``day``; a given schema saves reading footers for one."""
    reader = spark.read.schema(f"{schema}, {DAY} date") if schema else spark.read
    return reader.parquet(path)


def _moment(as_of) -> _dt.datetime:
    return _dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _day(at: _dt.datetime) -> Column:
    return F.lit(at.date())


def _bounds(df: DataFrame, low: _dt.datetime | None, high: _dt.datetime | None) -> DataFrame:
    if low is not None:
        df = df.filter(F.col(DAY) >= _day(low))
    if high is not None:
        df = df.filter(F.col(DAY) <= _day(high))
    return df


def trailing_window(df: DataFrame, time_col: str, as_of, days: int) -> DataFrame:
    """``time > as_of - days``, reading from that day on."""
    return SC.trailing_window(_bounds(df, _moment(as_of) - _dt.timedelta(days=days), None), time_col, as_of, days)


def bounded_history(df: DataFrame, time_col: str, as_of, days: int, tag_col: str | None = None, tag_value=None) -> DataFrame:
    """``as_of - days < time <= as_of`` and optionally ``tag = value``, reading those days only."""
    at = _moment(as_of)
    return SC.bounded_history(_bounds(df, at - _dt.timedelta(days=days), at), time_col, as_of, days, tag_col, tag_value)


def future_horizon(df: DataFrame, time_col: str, as_of) -> DataFrame:
    """Rows valid after ``as_of``, reading from its day on."""
    return SC.future_horizon(_bounds(df, _moment(as_of), None), time_col, as_of)


def between(df: DataFrame, time_col: str, start, end) -> DataFrame:
    """``start <= time < end``, reading those days only."""
    low, high = _moment(start), _moment(end)
    return _bounds(df, low, high).filter((F.col(time_col) >= ntz_lit(low)) & (F.col(time_col) < ntz_lit(high)))
