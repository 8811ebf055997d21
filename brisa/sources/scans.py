"""Time-window scans.  ``as_of`` is always passed in (never ``now()``), so
results repeat; literal bounds push down to the Parquet scan and prune
date partitions of a partitioned table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions.stamps import ntz_lit


def _ts(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return ntz_lit(as_of)


def _minus_days(as_of, days: int) -> Column:
    if isinstance(as_of, (str, _dt.datetime)):
        t = _dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        return ntz_lit(t - _dt.timedelta(days=days))
    return _ts(as_of) - F.make_dt_interval(F.lit(days))


def trailing_window(df: DataFrame, time_col: str, as_of, days: int) -> DataFrame:
    """``time > as_of - days`` (no upper bound, as the original query)."""
    return df.filter(F.col(time_col) > _minus_days(as_of, days))


def bounded_history(df: DataFrame, time_col: str, as_of, days: int,
                    tag_col: str | None = None, tag_value=None) -> DataFrame:
    """``as_of - days < time <= as_of`` and optionally ``tag = value``."""
    out = df.filter((F.col(time_col) > _minus_days(as_of, days)) & (F.col(time_col) <= _ts(as_of)))
    if tag_col is not None:
        out = out.filter(F.col(tag_col) == F.lit(tag_value))
    return out


def future_horizon(df: DataFrame, time_col: str, as_of) -> DataFrame:
    """Rows valid after ``as_of``."""
    return df.filter(F.col(time_col) > _ts(as_of))
