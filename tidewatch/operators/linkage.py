"""Probabilistic record linkage: blocking, comparison weights, scores, constrained clusters."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators.graph import components
from tidewatch.operators.scratch import cut

BLOCK_PAIRS = 300


def beside(ids: DataFrame, records: DataFrame, key_id: str) -> DataFrame:
    """(l, r): the records of pairs of ids (a, b)."""
    left = records.select(F.col(key_id).alias("a"), F.struct(*records.columns).alias("l"))
    right = records.select(F.col(key_id).alias("b"), F.struct(*records.columns).alias("r"))
    return ids.join(left, "a").join(right, "b").select("l", "r")


def blocked_pairs(records: DataFrame, key_id: str, keys: list[Column], within: Column | None = None, most: int = BLOCK_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(pairs a < b that share a block key, blocks dropped with their size).

    A block that would give more than ``most`` pairs is dropped and reported, which is the rule of the
    method; its size is known from a count before any pair is made. Only ids are paired and made distinct; records join last.
    """
    posted = records.select(F.col(key_id).alias("_id"), F.explode(F.array_compact(F.array(*keys))).alias("_key"))
    sizes = posted.groupBy("_key").agg(F.count("*").alias("n")).withColumn("pairs", F.col("n") * (F.col("n") - 1) / 2)
    ok = posted.join(sizes.where(F.col("pairs").between(1, most)).select("_key"), "_key")
    ids = ok.select("_key", F.col("_id").alias("a")).join(ok.select("_key", F.col("_id").alias("b")), "_key").where("a < b").select("a", "b").distinct()
    pairs = beside(ids, records, key_id)
    if within is not None:
        pairs = pairs.where(within)
    return pairs, sizes.where(F.col("pairs") > most).select(F.col("_key").alias("block"), "n")


def trigram_pairs(names: DataFrame, name: str, least: float) -> DataFrame:
    """(t, u, similarity): pairs of distinct names whose trigram sets overlap by ``least`` or more.

    With n trigrams at most ceil(least * n) of them may be the shared ones, so each name is posted under its
    n - ceil(least * n) + 1 rarest only: a pair that is similar enough meets in one of these.
    """
    g = names.select(F.col(name).alias("t"), T.trigrams(F.lower(name)).alias("g"))
    held = g.select("t", F.explode("g").alias("k"))
    rare = held.groupBy("k").agg(F.count("*").alias("df"))
    kept = F.size("v") - F.ceil(F.size("v") * least).cast("int") + 1
    posted = (
        held.join(rare, "k").groupBy("t").agg(F.array_sort(F.collect_list(F.struct("df", "k"))).alias("v"))
        .select("t", F.explode(F.slice(F.col("v.k"), F.lit(1), kept)).alias("k"))
    )
    pairs = posted.join(posted.select(F.col("t").alias("u"), "k"), "k").where("t < u").select("t", "u").distinct()
    both = pairs.join(g, "t").join(g.select(F.col("t").alias("u"), F.col("g").alias("h")), "u")
    similarity = F.size(F.array_intersect("g", "h")) / F.size(F.array_union("g", "h"))
    return both.select("t", "u", F.round(similarity, 9).alias("similarity")).where(F.col("similarity") >= least)


def weights(pairs: DataFrame, features: list[str], truth: str, smooth: float = 1.0) -> DataFrame:
    """(feature, level, m, u, weight): shares of each level among matches and others, and log2(m / u)."""
    long = pairs.select(truth, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level")) for f in features])).alias("x")).select(truth, "x.*")
    n = long.groupBy("feature", "level").agg(F.count_if(F.col(truth)).alias("km"), F.count_if(~F.col(truth)).alias("ku"))
    by = Window.partitionBy("feature")
    m = (F.col("km") + smooth) / (F.sum("km").over(by) + smooth * F.count("*").over(by))
    u = (F.col("ku") + smooth) / (F.sum("ku").over(by) + smooth * F.count("*").over(by))
    return n.select("feature", "level", m.alias("m"), u.alias("u"), F.log2(m / u).alias("weight"))


def scored(pairs: DataFrame, ids: list[str], features: list[str], table: DataFrame, prior: float) -> DataFrame:
    """(ids, p): the sum of weights and the prior log-odds, as a probability. The table has a row per level."""
    long = pairs.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level")) for f in features])).alias("x")).select(*ids, "x.*")
    total = long.join(F.broadcast(table.select("feature", "level", "weight")), ["feature", "level"]).groupBy(*ids).agg(F.sum("weight").alias("w"))
    return total.select(*ids, (1 / (1 + F.pow(2.0, -(F.col("w") + prior)))).alias("p"))


def by_component(work: DataFrame, one: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``one`` applied to the rows of each ``component``, from a sorted stream: no call per group, and no more than one held."""

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf["component"] == pdf["component"].iloc[-1]
            held = pdf[last]
            done = [one(g) for _, g in pdf[~last].groupby("component", sort=False)]
            if done:
                yield pd.concat(done, ignore_index=True)
        if held is not None and len(held):
            yield one(held)

    return work.repartition("component").sortWithinPartitions("component").mapInPandas(run, schema)


def clusters(pairs: DataFrame, a: str, b: str, auto: float = 0.9, review: float = 0.5, size: int = 10) -> DataFrame:
    """(id, cluster): greedy complete-linkage clusters over scored pairs (a, b, p, cannot).

    Pairs at ``auto`` or more merge by descending p, if every cross pair is at ``review`` or more and none
    is forbidden, up to ``size`` members. The greedy runs per component of pairs at ``review`` or more.
    """
    pairs = cut(pairs)
    label = components(pairs.where(F.col("p") >= review), a, b)
    # a pair matters to the greedy only if both ends are in one component
    at_b = label.select(F.col("id").alias(b), F.col("component").alias("_cb"))
    work = pairs.join(label.select(F.col("id").alias(a), "component"), a).join(at_b, b).where("component = _cb").drop("_cb")

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(pdf[a].tolist(), pdf[b].tolist(), pdf["p"].tolist(), pdf["cannot"].tolist()))
        p = {(x, y): v for x, y, v, _ in rows}
        no = {(x, y) for x, y, _, c in rows if c}
        of = {x: {x} for x in sorted({i for r in rows for i in r[:2]})}
        for x, y, v, _ in sorted(rows, key=lambda t: (-t[2], t[0], t[1])):
            one, two = of[x], of[y]
            if v < auto or one is two or len(one) + len(two) > size:
                continue
            cross = [(min(i, j), max(i, j)) for i in one for j in two]
            if all(c not in no and p.get(c, 0.0) >= review for c in cross):
                one |= two
                for i in two:
                    of[i] = one
        return pd.DataFrame({"id": list(of), "cluster": [min(s) for s in of.values()]})

    return by_component(work, greedy, "id long, cluster long")
