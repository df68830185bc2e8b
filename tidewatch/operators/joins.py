"""Joins that need care: as-of, interval, range, disjunctive and one-to-one joins as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, on: list[str], at: str, value: str, days: int) -> DataFrame:
    """``left`` with ``value`` of the last ``right`` row at or before the day ``at``, at most ``days`` back.

    A right row serves its own day and the ``days`` after it; the latest that serves a day is its value. The join
    is then on (key, day), so a key with a third of all rows is dealt over its days, and nothing is sorted.
    ``right`` has one row per key and day.
    """
    served = (
        right.select(*on, F.col(at).alias("_from"), value)
        .withColumn(at, F.explode(F.sequence("_from", F.date_add("_from", days))))
        .groupBy(*on, at).agg(F.max_by(value, "_from").alias(value))
    )
    return left.join(served, [*on, at], "left").select(*left.columns, value)


def prefix_lookup(points: DataFrame, prefixes: DataFrame, point: str, lo: str, hi: str, best: list[Column]) -> DataFrame:
    """Each point with the best prefix that holds it (``best`` orders; left join).

    Prefixes are ranges of a power of two, aligned to their size: for each size that occurs (64 at most) a
    point's address without its low bits is an equi-join key. Distinct addresses are looked up once.
    """
    size = F.col(hi) - F.col(lo) + 1
    sizes = sorted(r[0] for r in prefixes.select(size.alias("size")).distinct().limit(65).collect())
    if len(sizes) > 64 or any(n & (n - 1) for n in sizes):
        raise ValueError("prefixes have sizes that are powers of two")
    every = F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])) if sizes else F.lit(None).cast("long")
    asked = points.select(point).where(F.col(point).isNotNull()).distinct().withColumn("_size", every)
    asked = asked.withColumn("_lo", F.col(point) - F.pmod(F.col(point), F.col("_size")))
    held = prefixes.select("*", size.cast("long").alias("_size"), F.col(lo).alias("_lo"))
    found = asked.join(held, ["_size", "_lo"]).groupBy(point).agg(
        F.min_by(F.struct(*prefixes.columns), F.struct(*[c.alias(f"_{k}") for k, c in enumerate(best)])).alias("_best"))
    return points.join(found, point, "left").select(*points.columns, "_best.*")


def any_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[Column, Column]], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) of rows that agree on at least one pair of keys: a union of equi-joins."""
    out = None
    for k, (a, b) in enumerate(pairs):
        one = (
            left.select(left_id, a.alias("_k")).where("_k is not null")
            .join(right.select(right_id, b.alias("_k")).where("_k is not null"), "_k").select(left_id, right_id)
        )
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def one_to_one(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str) -> DataFrame:
    """Every left row with its outcome: joined, ambiguous (several on either side) or missing."""
    l = left.withColumn("_nl", F.count("*").over(Window.partitionBy(*on)))
    r = right.groupBy(*on).agg(F.count("*").alias("_nr"), F.min(right_id).alias(right_id))
    outcome = (
        F.when(F.col("_nr").isNull(), "missing").when((F.col("_nl") > 1) | (F.col("_nr") > 1), "ambiguous").otherwise("joined"))
    j = l.join(r, on, "left").withColumn("outcome", outcome)
    return j.select(left_id, F.when(F.col("outcome") == "joined", F.col(right_id)).alias(right_id), "outcome")
