"""Aggregates kept up to date: partial results of each load, merged when asked.

``CubePartials``: counts at the finest grain of a cube, one partition for each
load.  ``DistinctSketches``: HyperLogLog sketches for each key and day.  A load
writes its own partition and nothing else, a load that is run again replaces
itself, and an answer reads partials only - never the rows of an earlier load.
Both can be folded: the partials of many loads become one.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD = "load_id"


def _overwrite_load(df: DataFrame, path: str, load_id: str, *by: str) -> None:
    (df.withColumn(LOAD, F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(LOAD, *by).parquet(path))


@dataclass(frozen=True)
class CubePartials:
    """Counts of rows (``n``) and of matching rows (``m``) by ``dims``, for each load, under ``path``."""

    spark: SparkSession
    path: str
    dims: tuple[str, ...]

    def add(self, load_id: str, rows: DataFrame, matching: Column | None = None) -> None:
        """Count a load's rows by ``dims``; ``matching`` marks those that count as matches too."""
        match = F.count_if(matching) if matching is not None else F.lit(0).cast("bigint")
        _overwrite_load(rows.groupBy(*self.dims).agg(F.count(F.lit(1)).alias("n"), match.alias("m")), self.path, load_id)

    def finest(self) -> DataFrame:
        """All loads merged: one row for each cell of the finest grain."""
        cells = self.spark.read.parquet(self.path)
        return cells.groupBy(*self.dims).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))

    def cube(self) -> DataFrame:
        """``dims``, ``n``, ``m``, ``gid`` of the full cube over everything loaded."""
        return self.finest().cube(*self.dims).agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.grouping_id().alias("gid"))

    def share(self) -> DataFrame:
        """The cube with ``ratio``, the matching percentage (null for an empty cell)."""
        return self.cube().withColumn("ratio", F.try_divide(F.col("m").cast("double") * 100.0, F.col("n").cast("double")))

    def loads(self) -> DataFrame:
        """``load_id, cells, n`` of every load."""
        return self.spark.read.parquet(self.path).groupBy(F.col(LOAD).cast("string").alias(LOAD)).agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class DistinctSketches:
    """Sketches of the distinct ``value`` of each key and day under ``path``; the union of sketches is the sketch of the union."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    lg_k: int = 12

    @property
    def error(self) -> float:
        """Relative standard error of an estimate."""
        return 1.04 / 2 ** (self.lg_k / 2)

    def add(self, load_id: str, rows: DataFrame, value: str, time_col: str) -> None:
        """Sketch a load's rows by key and day (partial sketches are merged map-side)."""
        sketched = rows.withColumn("day", F.to_date(time_col)).groupBy(*self.keys, "day").agg(F.hll_sketch_agg(value, self.lg_k).alias("sketch"))
        _overwrite_load(sketched, self.path, load_id)

    def estimates(self, since=None, until=None, by: Sequence[str] | None = None) -> DataFrame:
        """``by`` (the keys, or some of them) and ``users``: distinct values over the days asked for."""
        rows = self.spark.read.parquet(self.path)
        if since is not None:
            rows = rows.filter(F.col("day") >= F.lit(since).cast("date"))
        if until is not None:
            rows = rows.filter(F.col("day") <= F.lit(until).cast("date"))
        by = list(self.keys if by is None else by)
        return rows.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))

    def having(self, more_than: int, **days) -> DataFrame:
        """Keys with an estimate of more than ``more_than``."""
        return self.estimates(**days).filter(F.col("users") > more_than)
