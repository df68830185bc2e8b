"""Connected components by alternating large-star and small-star rounds.

Each half round is a min-aggregation per vertex (combined before the shuffle) and an equi-join
back, so a vertex with very many neighbours is split by the adaptive skew join. The edges of a
round are a scratch table; the loop ends when a round leaves them as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.join(low, "a").where("b > a and b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge points from its larger to its smaller end here.
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for each id that has an edge to a smaller one.

    Ids without a row are their own component. Null ends and self loops are ignored; repeated
    edges count once; an empty edge table gives an empty result.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = store.saved(
        edges.where(f"{a} is not null and {b} is not null and {a} <> {b}")
        .select(hi.alias("a"), lo.alias("b")).distinct(),
        "edges",
    )
    seen = _digest(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        after = store.saved(_small_star(_large_star(now)), "edges")
        store.drop(now)
        now, before = after, seen
        seen = _digest(now)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
