"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.scratch import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the smallest of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every neighbour below a vertex is tied to the smallest of them; edges point from larger to smaller."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of an edge that isn't a self loop.

    Each round is two aggregations by vertex with joins back; the edges of a round replace those of the
    one before, and their number never grows. It ends when a round leaves them as they were.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and u <> v").distinct())
    digest = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = digest(e)
    for _ in range(max_rounds):
        e = cut(_small_star(_large_star(e)))
        now = digest(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
