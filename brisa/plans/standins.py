"""Map the test-data tables onto the shapes the reference's jobs read.

* business  <- part:      business_id=p_partkey, name/categories=p_name (space
  separated tokens), state=p_brand, city=p_type, stars=p_partkey mod 5 + 1,
  review_count=p_size, latitude=p_retailprice
* review    <- documents: review_id=doc_id, business_id=doc_id * 7919 mod (rows of part), text,
  stars=doc_id mod 5 + 1, user_id=doc_id mod 37
* user-review pairs <- lineitem join orders: user_id=o_custkey, business_id=l_partkey
* user      <- customer:  user_id=c_custkey, average_stars=c_acctbal,
  review_count = number of orders of the customer (derived)
* Generation  <- events: time=ts, Total=value
* MetForecasts <- events: time = 3-hour bin of ts, Direction = compass point
  of props.k mod 16, Speed = value / 10, Source_time = props.k,
  Lead_hours = props.k mod 6 + 1
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions.compass import compass_point
from brisa.plans.tables import table

# Fixed stand-in parameters (documented in FIXTURES.md).
AUTH = ["whou", "eaux"]
NEG = ["ouen", "licen"]
CATEGORY_SEP = " "


def business(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("name"),
        F.col("p_name").alias("categories"), F.col("p_brand").alias("state"),
        F.col("p_type").alias("city"), (F.pmod("p_partkey", F.lit(5)) + 1).alias("stars"),
        F.col("p_size").alias("review_count"), F.col("p_retailprice").alias("latitude"))


def reviews(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").count()
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("review_id"), F.pmod(F.col("doc_id") * 7919, F.lit(max(n, 1))).alias("business_id"),
        F.pmod("doc_id", F.lit(37)).alias("user_id"), "text",
        (F.pmod("doc_id", F.lit(5)) + 1).alias("stars"))


def user_reviews(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("business_id"))


def users(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("review_count"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                           F.col("c_acctbal").alias("average_stars"))
    return c.join(counts, c.user_id == counts.o_custkey, "left").select(
        "user_id", "average_stars", F.coalesce("review_count", F.lit(0)).alias("review_count"))


def _k(col="props"):
    return F.get_json_object(F.col(col), "$.k").cast("int")


def generation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("ts").alias("time"), F.col("value").alias("Total"), F.col("event_id"))


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "value", "props")
    k = _k()
    return e.select(
        "event_id",
        F.window("ts", "3 hours").start.alias("time"),
        compass_point(k).alias("Direction"),
        (F.pmod(k, F.lit(6)) + 1).alias("Lead_hours"),
        k.cast("bigint").alias("Source_time"),
        (F.col("value") / 10.0).alias("Speed"))
