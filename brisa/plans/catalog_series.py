"""Registered queries: time-window scans, cleaning, resampling, time joins,
compass / stamp functions and the wind training-set analyses (E11, E13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions.compass import COMPASS_POINTS, compass_angle
from brisa.functions.stamps import epoch_seconds, parse_stamp, stamp_text, stamp_to_int
from brisa.operators import timeseries as TS
from brisa.operators.relational import newest_rows
from brisa.plans import standins as S
from brisa.plans import wind as W
from brisa.plans.registry import register
from brisa.plans.tables import table as T
from brisa.sources import scans as SC

# Stand-in parameters: the analysis time ("now" of the original queries) is explicit.
AS_OF = "2024-01-25 00:00:00"
HISTORY_DAYS = 365

_POINTS = "[" + ", ".join(f"'{p}'" for p in COMPASS_POINTS) + "]"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
GEN_SQL = "SELECT ts AS time, value AS Total, event_id FROM events"
FC_SQL = f"""SELECT event_id, time_bucket(INTERVAL 3 HOUR, ts) AS time,
    {_POINTS}[{_K} % 16 + 1] AS Direction, {_K} % 6 + 1 AS Lead_hours,
    CAST({_K} AS BIGINT) AS Source_time, value / 10.0 AS Speed FROM events"""
ANGLE_SQL = f"(list_position({_POINTS}, Direction) - 1) * CAST(22.5 AS DOUBLE)"
E11_SQL = f"""WITH gen AS ({GEN_SQL}), fc AS ({FC_SQL}),
    energy AS (SELECT time_bucket(INTERVAL 3 HOUR, time) AS time, avg(Total) AS Total FROM gen
               WHERE time > TIMESTAMP '2023-01-25 00:00:00' AND Total > 0 AND NOT isnan(Total) GROUP BY 1),
    wind AS (SELECT *, {ANGLE_SQL} AS Angle FROM fc WHERE time > TIMESTAMP '2023-01-25 00:00:00'
             AND time <= TIMESTAMP '2024-01-25 00:00:00' AND Lead_hours = 1)
    SELECT e.time, e.Total AS Energy, w.event_id, w.Direction, w.Lead_hours, w.Source_time, w.Speed, w.Angle
    FROM energy e JOIN wind w ON e.time = w.time"""


def _date_label(df):
    """Calendar date as midnight TIMESTAMP_NTZ (same value type in both engines)."""
    return df.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


def training_set(spark, d):
    return W.e11_training_set(S.generation(spark, d), S.forecasts(spark, d), AS_OF, HISTORY_DAYS, 1)


@register("trailing_window", f"""SELECT event_id, time, Total FROM ({GEN_SQL})
    WHERE time > TIMESTAMP '2024-01-22 00:00:00'""")
def trailing_window(spark, d):
    return SC.trailing_window(S.generation(spark, d), "time", AS_OF, 3)


@register("bounded_history", f"""SELECT event_id, time FROM ({FC_SQL}) WHERE time > TIMESTAMP '2023-01-25 00:00:00'
    AND time <= TIMESTAMP '2024-01-25 00:00:00' AND Lead_hours = 1""")
def bounded_history(spark, d):
    return SC.bounded_history(S.forecasts(spark, d), "time", AS_OF, HISTORY_DAYS, "Lead_hours", 1) \
        .select("event_id", "time")


@register("future_horizon", f"SELECT event_id, time FROM ({FC_SQL}) WHERE time > TIMESTAMP '2024-01-25 00:00:00'")
def future_horizon(spark, d):
    return SC.future_horizon(S.forecasts(spark, d), "time", AS_OF).select("event_id", "time")


@register("clean_positive", f"SELECT event_id, time, Total FROM ({GEN_SQL}) WHERE Total > 50 AND NOT isnan(Total)")
def clean_positive(spark, d):
    return TS.positive_values(S.generation(spark, d), "Total", 50.0)


@register("latest_source", f"""SELECT event_id, Source_time FROM ({FC_SQL})
    WHERE Source_time = (SELECT max(Source_time) FROM ({FC_SQL}))""")
def latest_source(spark, d):
    return newest_rows(S.forecasts(spark, d), "Source_time").select("event_id", "Source_time")


@register("resample_3h", f"""SELECT time_bucket(INTERVAL 3 HOUR, time) AS time, round(avg(Total), 6) AS Total
    FROM ({GEN_SQL}) GROUP BY 1""")
def resample_3h(spark, d):
    out = TS.resample_mean(S.generation(spark, d), "time", ["Total"])
    return out.withColumn("Total", F.round("Total", 6))


@register("resample_fill", f"""WITH m AS (SELECT time_bucket(INTERVAL 1 MINUTE, time) AS time, avg(Total) AS Total
      FROM ({GEN_SQL}) GROUP BY 1),
    g AS (SELECT unnest(generate_series((SELECT min(time) FROM m), (SELECT max(time) FROM m),
                                        INTERVAL 1 MINUTE)) AS time)
    SELECT g.time, round(m.Total, 6) AS Total FROM g LEFT JOIN m ON g.time = m.time""")
def resample_fill(spark, d):
    """1-minute means over the whole table: most minutes hold no event, so
    the gap filling is exercised without dropping any rows."""
    out = TS.resample_fill(S.generation(spark, d), "time", ["Total"], 1)
    return out.withColumn("Total", F.round("Total", 6))


@register("hourly_mean", f"""SELECT CAST(CAST(time AS DATE) AS TIMESTAMP) AS Date, CAST(hour(time) AS INTEGER) AS Hour,
    round(avg(Total), 6) AS Total_Average FROM ({GEN_SQL}) GROUP BY 1, 2""")
def hourly_mean(spark, d):
    out = TS.hourly_mean(S.generation(spark, d), "time", "Total")
    return _date_label(out.withColumn("Total_Average", F.round("Total_Average", 6)))


@register("time_join", f"""WITH m AS (SELECT time_bucket(INTERVAL 3 HOUR, time) AS time, avg(Total) AS Total
      FROM ({GEN_SQL}) GROUP BY 1)
    SELECT m.time, round(m.Total, 6) AS Total, f.event_id, f.Direction, f.Speed
    FROM m JOIN ({FC_SQL}) f ON m.time = f.time""")
def time_join(spark, d):
    m = TS.resample_mean(S.generation(spark, d), "time", ["Total"])
    f = S.forecasts(spark, d).select("time", "event_id", "Direction", "Speed")
    return TS.time_join(m, f).withColumn("Total", F.round("Total", 6))


@register("lookup_join", f"""SELECT event_id, Direction, {ANGLE_SQL} AS Angle FROM
    (SELECT event_id, CASE WHEN Source_time = 99 THEN 'XYZ' ELSE Direction END AS Direction FROM ({FC_SQL}))""")
def lookup_join(spark, d):
    """Compass lookup as a join with the 16-row table (fixed size, broadcast);
    unknown points get a null angle."""
    compass = spark.createDataFrame([(p, float(i) * 22.5) for i, p in enumerate(COMPASS_POINTS)],
                                    "Direction string, Angle double")
    f = S.forecasts(spark, d).select(
        "event_id", F.when(F.col("Source_time") == 99, F.lit("XYZ")).otherwise(F.col("Direction"))
        .alias("Direction"))
    return f.join(F.broadcast(compass), "Direction", "left")


@register("compass_angle", f"SELECT event_id, Direction, {ANGLE_SQL} AS Angle FROM ({FC_SQL})")
def compass_angle_q(spark, d):
    return S.forecasts(spark, d).select("event_id", "Direction", compass_angle("Direction").alias("Angle"))


_STAMP = "strftime(ts, '%Y-%-m-%-d-%-H-%-M-%-S')"


@register("stamp_roundtrip", f"""SELECT event_id, {_STAMP} AS stamp, date_trunc('second', ts) AS parsed
    FROM events""")
def stamp_roundtrip(spark, d):
    e = T(spark, d, "events").select("event_id", stamp_text("ts").alias("stamp"))
    return e.withColumn("parsed", parse_stamp("stamp"))


@register("stamp_to_int", f"SELECT event_id, CAST(replace({_STAMP}, '-', '') AS BIGINT) AS stamp_int FROM events")
def stamp_to_int_q(spark, d):
    return T(spark, d, "events").select("event_id", stamp_to_int(stamp_text("ts")).alias("stamp_int"))


@register("epoch_seconds", f"""SELECT event_id, TIMESTAMP '1970-01-01 00:00:00'
    + to_seconds(Source_time * 3600 + 1704067200) AS source_ts FROM ({FC_SQL})""")
def epoch_seconds_q(spark, d):
    f = S.forecasts(spark, d)
    return f.select("event_id", epoch_seconds(F.col("Source_time") * 3600 + 1704067200).alias("source_ts"))


@register("e11_training_set", f"""SELECT time, round(Energy, 6) AS Energy, event_id, Direction, Lead_hours,
    Source_time, Speed, Angle FROM ({E11_SQL})""")
def e11_training_set(spark, d):
    return training_set(spark, d).withColumn("Energy", F.round("Energy", 6))


@register("e13_hourly_actuals", f"""SELECT CAST(CAST(time AS DATE) AS TIMESTAMP) AS Date, CAST(hour(time) AS INTEGER) AS Hour,
    round(avg(Total), 6) AS Total_Average FROM ({GEN_SQL})
    WHERE time > TIMESTAMP '2024-01-22 00:00:00' AND Total > 0 AND NOT isnan(Total) GROUP BY 1, 2""")
def e13_hourly_actuals(spark, d):
    out = W.e13_hourly_actuals(S.generation(spark, d), AS_OF, 3)
    return _date_label(out.withColumn("Total_Average", F.round("Total_Average", 6)))
