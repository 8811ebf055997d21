"""One-off ingest of JSON lines: typed Parquet rows, and a quarantine of the lines that are not rows.

A line is parsed once.  What does not parse, or does not fit the schema, keeps
its text and its file and goes to the quarantine; all else goes to the rows.  Both
are partitions (``part=rows`` / ``part=quarantine``) of one table written by one
job, so there is one scan of the JSON and neither half can be there without the
other.  Later jobs read columns of Parquet; they never parse JSON again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, LINE, FILE = "part", "_line", "_file"
ROWS, QUARANTINE = "rows", "quarantine"


@dataclass(frozen=True)
class Ingested:
    """Where an ingest went, and the schema of its rows."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _part(self, part: str, schema: T.StructType) -> DataFrame:
        table = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(self.path)
        return table.filter(F.col(PART) == part).drop(PART)

    def rows(self) -> DataFrame:
        return self._part(ROWS, self.schema)

    def quarantine(self) -> DataFrame:
        """``line`` and ``file`` of every line that is not a row."""
        kept = T.StructType([T.StructField(LINE, T.StringType()), T.StructField(FILE, T.StringType())])
        return self._part(QUARANTINE, kept).select(F.col(LINE).alias("line"), F.col(FILE).alias("file"))

    def counts(self) -> DataFrame:
        """``n_rows`` and ``n_quarantined``: one pass over the partition column, no other column is read."""
        table = self.spark.read.schema(f"{PART} string").parquet(self.path)
        return table.agg(F.count_if(F.col(PART) == ROWS).alias("n_rows"), F.count_if(F.col(PART) == QUARANTINE).alias("n_quarantined"))


def _kinds(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def ingest_jsonl(spark: SparkSession, source: str | list[str], schema: str | T.StructType, path: str, required: tuple[str, ...] = (),
                 check: Column | None = None) -> Ingested:
    """Parse JSON lines into ``path`` (replaced).

    A line goes to the quarantine if it is no JSON object of the schema's types, if one of ``required`` is
    null, or if ``check`` is not true.  Blank lines are no lines.
    """
    kinds = _kinds(schema)
    parsed = (spark.read.schema(T.StructType([*kinds.fields, T.StructField(LINE, T.StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).json(source))
    bad = F.col(LINE).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    if check is not None:
        bad = bad | ~F.coalesce(check, F.lit(False))
    whole = F.to_json(F.struct(*[F.col(f.name) for f in kinds.fields]))
    rows = parsed.withColumn("__bad", bad).select(
        *[F.when(~F.col("__bad"), F.col(f.name)).alias(f.name) for f in kinds.fields],
        F.when(F.col("__bad"), F.coalesce(LINE, whole)).alias(LINE),
        F.when(F.col("__bad"), F.col("_metadata.file_name")).alias(FILE),
        F.when(F.col("__bad"), QUARANTINE).otherwise(ROWS).alias(PART))
    rows.write.mode("overwrite").partitionBy(PART).parquet(path)
    return Ingested(spark, path, kinds)


def ingested(spark: SparkSession, schema: str | T.StructType, path: str) -> Ingested:
    """An ingest that an earlier job wrote."""
    return Ingested(spark, path, _kinds(schema))
