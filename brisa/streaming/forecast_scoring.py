"""The periodic "load newest forecasts -> score -> append predictions" job
as a Structured Streaming query.

New forecast files landing in a folder are picked up by a file stream;
``foreachBatch`` scores each micro-batch against the stored KNN model
(training rows + k).  ``trigger(availableNow=True)`` processes whatever has
landed and stops, so the same code serves a scheduled batch run and a
continuous one.

Repeatable: the caller names the checkpoint folder, which must stay the same
from run to run and lie on shared storage; files seen before are not scored
again.  Each micro-batch replaces its own ``batch_id`` partition, so an attempt
that failed half-way and is replayed leaves no second copy.  A predictions
folder therefore belongs to one checkpoint.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions.compass import compass_angle
from brisa.functions.stamps import ntz_lit, stamp_text
from brisa.operators.relational import newest_rows
from brisa.plans.wind import score_forecasts
from brisa.sources.sinks import load_model


def _newest(spark: SparkSession, batch: DataFrame, predictions: str, batch_id: int) -> DataFrame:
    """Rows of the batch's newest source run, unless an earlier batch scored a newer one."""
    fresh = newest_rows(batch, "Source_time")
    try:
        known = spark.read.parquet(predictions).filter(F.col("batch_id") != batch_id).agg(F.max("Source_time")).first()[0]
    except AnalysisException:  # nothing was saved yet
        known = None
    return fresh if known is None else fresh.filter(F.col("Source_time") >= F.lit(known))


def score_new_forecasts(spark: SparkSession, landing: str, schema, model_path: str,
                        predictions: str, checkpoint: str, id_col: str = "event_id", newest_only: bool = False,
                        run_time: _dt.datetime | None = None) -> None:
    """Score every forecast file that landed since the last run with this checkpoint.

    ``run_time`` fixes the stamp of this run (defaults to the batch start);
    pass it explicitly for repeatable runs.
    """
    rows, k = load_model(spark, model_path)
    stream = spark.readStream.schema(schema).parquet(landing)

    def handle(batch: DataFrame, batch_id: int) -> None:
        fc = _newest(spark, batch, predictions, batch_id) if newest_only else batch
        scored = score_forecasts(rows, k, fc.withColumn("Angle", compass_angle("Direction")), id_col)
        stamp = ntz_lit(run_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0))
        (scored.withColumn("prediction_time", stamp).withColumn("prediction_stamp", stamp_text(stamp))
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(predictions))

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
