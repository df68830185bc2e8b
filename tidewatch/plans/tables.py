"""The tables in their analytical roles.

orders: one assertion a row (source = priority, vuln = customer, added = order date; status P is
withdrawn). events: sightings (source = type, vuln = user). customer: the registry (score =
balance, segment). lineitem: dated fixes and network counts (supplier = network, flag = feed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Last day on which all collectors are known to have worked; always a parameter, never the clock.
CENSORED = "2000-12-31"

ASSERTIONS = """a AS (
  SELECT o_orderpriority AS source, o_orderkey AS entry, o_custkey AS vuln, CAST(o_orderdate AS DATE) AS added,
         o_orderstatus = 'P' AS withdrawn, o_totalprice AS price FROM orders)"""
OBSERVATIONS = """o AS (
  SELECT event_type AS source, user_id AS vuln, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)"""
REGISTRY = "r AS (SELECT c_custkey AS vuln, c_acctbal AS score, c_mktsegment AS segment, c_nationkey AS nation FROM customer)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("entry"), F.col("o_custkey").alias("vuln"),
        F.to_date("o_orderdate").alias("added"), (F.col("o_orderstatus") == "P").alias("withdrawn"),
        F.col("o_totalprice").alias("price"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("source"), F.col("user_id").alias("vuln"), F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"))
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vuln"), F.col("c_acctbal").alias("score"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"))
