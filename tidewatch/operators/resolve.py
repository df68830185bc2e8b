"""One value per subject and field from many claims: precedence, disagreement, tiers, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(value: Column, order: list[str]) -> Column:
    """Place of a value in ``order``; unknown ones come last."""
    out = F.lit(len(order))
    for k, v in reversed(list(enumerate(order))):
        out = F.when(value == v, k).otherwise(out)
    return out


def by_precedence(claims: DataFrame, keys: list[str], bases: list[str], as_of: str, claim_id: str, basis: str = "basis") -> DataFrame:
    """The winning claim per key: basis order, then latest, then smallest id."""
    w = Window.partitionBy(*keys).orderBy(ranked(F.col(basis), bases), F.col(as_of).desc_nulls_last(), claim_id)
    return claims.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def disagreements(claims: DataFrame, keys: list[str], source: str, value: str, ratio: float = 1.10) -> DataFrame:
    """(keys, sources, lo, hi, disagree): more than one source and the highest over ``ratio`` times the lowest."""
    d = claims.groupBy(*keys).agg(F.count_distinct(source).alias("sources"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    return d.withColumn("disagree", (F.col("sources") > 1) & (F.col("hi") > F.col("lo") * ratio))


def top_tier(claims: DataFrame, keys: list[str], tier: str, value: str) -> DataFrame:
    """(keys, tier, value, conflict): the value that all claims of the best tier share, else a conflict."""
    best = claims.groupBy(*keys).agg(F.min(tier).alias(tier))
    d = claims.join(best, [*keys, tier]).groupBy(*keys, tier).agg(F.count_distinct(value).alias("n"), F.min(value).alias("v"))
    return d.select(*keys, tier, F.when(F.col("n") == 1, F.col("v")).alias(value), (F.col("n") > 1).alias("conflict"))


def first_identity(records: DataFrame, record_id: str, keys: list[str]) -> DataFrame:
    """(record_id, owner): the smallest record that shares the strongest key that is shared at all.

    ``keys`` go from strong to weak; a null key matches nothing. Each key is counted with partial sums and only
    the shared ones are joined back, so a key that very many records hold, or lack, sorts nowhere.
    """
    d = records.select(record_id, *keys)
    for k in keys:
        shared = d.where(F.col(k).isNotNull()).groupBy(k).agg(F.count("*").alias("_n"), F.min(record_id).alias(f"_{k}")).where("_n > 1").drop("_n")
        d = d.join(shared, k, "left")
    return d.select(record_id, F.coalesce(*[F.col(f"_{k}") for k in keys], F.col(record_id)).alias("owner"))
