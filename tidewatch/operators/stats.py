"""Estimators as DataFrame operators: intervals, ranks, false-discovery selection, mixtures."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import special


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The two ends of the score interval, within 0 and 1."""
    p = k / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.greatest(F.lit(0.0), (mid - half) / (1 + z * z / n)), F.least(F.lit(1.0), (mid + half) / (1 + z * z / n))


def average_ranks(rows: DataFrame, value: str, by: list[str], out: str) -> DataFrame:
    """Ranks from 1, ties get their mean, from counts per distinct value (no row-wise sort of one task).

    Values are summed up first, so the ordered window runs over distinct values only.
    """
    w = Window.partitionBy(*by, ) if by else Window.partitionBy(F.lit(0))
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranks = counts.withColumn(out, upto - (F.col("_c") - 1) / 2).drop("_c")
    return rows.join(ranks, [*by, value])


def auc(rows: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """(by, positives, negatives, auc) by the rank sum; null without both kinds."""
    d = average_ranks(rows, score, by, "_r")
    p = F.sum(F.col(label).cast("double"))
    n = F.count("*") - p
    return d.groupBy(*by).agg(
        p.cast("long").alias("positives"), n.cast("long").alias("negatives"),
        F.try_divide(F.sum(F.when(F.col(label) == 1, F.col("_r"))) - p * (p + 1) / 2, p * n).alias("auc"))


def spearman(rows: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    d = average_ranks(average_ranks(rows, x, by, "_x"), y, by, "_y")
    return d.groupBy(*by).agg(F.corr("_x", "_y").alias("spearman"))


def gini(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Concentration of a non-negative value within groups."""
    d = average_ranks(rows, value, by, "_r")
    n, s = F.count("*"), F.sum(value)
    return d.groupBy(*by).agg((F.try_divide(2 * F.sum(F.col("_r") * F.col(value)), n * s) - (n + 1) / n).alias("gini"))


def fdr_prefix(rows: DataFrame, p: str, by: list[str], key: str, level: float, buckets: int = 1024) -> DataFrame:
    """``rows`` with ``selected``: the longest prefix, by descending ``p``, whose mean of 1 - p is within ``level``.

    Rows are dealt into ranges of ``p``; a window over a group's ranges gives what lies before each, and rows are
    ordered within their range only.
    """
    miss = F.when(F.col(p).isNotNull(), 1 - F.col(p))
    d = rows.withColumn("_b", F.coalesce(F.floor(F.col(p) * buckets), F.lit(-1)))
    sums = d.groupBy(*by, "_b").agg(F.count("*").alias("_n"), F.sum(miss).alias("_s"))
    before = Window.partitionBy(*by).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"))
    upto = Window.partitionBy(*by, "_b").orderBy(F.col(p).desc(), key).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(sums, [*by, "_b"]).withColumn("_k", F.col("_n0") + F.count("*").over(upto)).withColumn("_m", (F.col("_s0") + F.sum(miss).over(upto)) / F.col("_k"))
    last = d.groupBy(*by).agg(F.max(F.when(F.col("_m") <= level, F.col("_k"))).alias("_last"))
    return d.join(last, by).withColumn("selected", F.coalesce(F.col("_k") <= F.col("_last"), F.lit(False))).select(*rows.columns, "selected")


def latent_classes(rows: DataFrame, flags: list[str], rounds: int = 400) -> DataFrame:
    """(pattern, n, p): two-class latent class analysis on yes/no columns.

    Rows collapse to at most 2**len(flags) weighted patterns before the fit, which then is one
    small group whatever the number of rows.
    """
    pattern = F.concat(*[F.col(c).cast("int").cast("string") for c in flags])
    counts = rows.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pattern", ignore_index=True)
        x = np.array([[int(c) for c in p] for p in pdf["pattern"]], float)
        n = pdf["n"].to_numpy(float)
        prior, yes = 0.2, np.array([np.full(x.shape[1], 0.7), np.full(x.shape[1], 0.1)])
        for _ in range(rounds):
            logs = x @ np.log(yes).T + (1 - x) @ np.log(1 - yes).T + np.log([prior, 1 - prior])
            post = 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -700, 700)))
            w = np.stack([post, 1 - post]) * n
            prior = float(np.clip(w[0].sum() / n.sum(), 1e-4, 1 - 1e-4))
            yes = np.clip((w @ x) / np.maximum(w.sum(axis=1), 1e-12)[:, None], 1e-4, 1 - 1e-4)
        if yes[0].mean() < yes[1].mean():
            post = 1 - post
        return pdf.assign(p=post)

    return counts.groupBy(F.lit(0).alias("g")).applyInPandas(lambda pdf: fit(pdf[["pattern", "n"]]), "pattern string, n long, p double")


def intensity_fit(rows: DataFrame, side: str, feeds: list[str], sizes: str, rounds: int = 200, tol: float = 1e-6) -> DataFrame:
    """One latent log-intensity per network and side, from counts of several feeds.

    A feed's count is negative binomial with mean size * exp(a_feed + theta), theta normal; EM on a
    grid of theta, damped Newton steps for the feeds. Networks with equal counts and size are one
    weighted row, so a fit's input grows with distinct rows only. Returns per distinct row: side, counts,
    size, weight, mean intensity, 10 % point, and whether the fit converged.
    """
    cols = [*feeds, sizes]
    grouped = rows.groupBy(side, *cols).agg(F.count("*").alias("weight"))
    schema = f"{side} string, " + ", ".join(f"{c} long" for c in cols) + ", weight long, intensity double, low double, converged boolean"
    grid = np.linspace(-6, 6, 73)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(cols, ignore_index=True)
        y, size, w = pdf[feeds].to_numpy(float), pdf[sizes].to_numpy(float), pdf["weight"].to_numpy(float)
        a = np.log((w @ y + 0.5) / (w @ size))
        r, mu, tau, last, done = np.ones(len(feeds)), 0.0, 1.0, -np.inf, False
        for _ in range(rounds):
            mean = size[:, None, None] * np.exp(a[None, None, :] + grid[None, :, None])
            like = special.nb_logpmf(y[:, None, :], mean, r[None, None, :]).sum(axis=2) - 0.5 * ((grid - mu) / tau) ** 2
            top = like.max(axis=1, keepdims=True)
            post = np.exp(like - top)
            total = float(w @ (np.log(post.sum(axis=1)) + top[:, 0]))
            post /= post.sum(axis=1, keepdims=True)
            m = post @ grid
            mu = float(w @ m / w.sum())
            tau = float(np.clip(np.sqrt(w @ (post @ grid**2 - 2 * mu * m + mu * mu) / w.sum()), 0.05, 4))
            for f in range(len(feeds)):
                mf = mean[:, :, f]
                grad = (w[:, None] * post * r[f] * (y[:, [f]] - mf) / (r[f] + mf)).sum()
                hess = (w[:, None] * post * r[f] * mf * (r[f] + y[:, [f]]) / (r[f] + mf) ** 2).sum()
                a[f] += np.clip(grad / max(hess, 1e-9), -1, 1)
                var = (w[:, None] * post * ((y[:, [f]] - mf) ** 2 - mf)).sum()
                r[f] = np.clip((w[:, None] * post * mf**2).sum() / max(var, 1e-9), 0.05, 1e4)
            # the mean intensity is pinned: its shift belongs to the feeds
            a, mu = a + mu, 0.0
            if abs(total - last) < tol * (1 + abs(total)):
                done = True
                break
            last = total
        low = grid[np.argmax(np.cumsum(post, axis=1) >= 0.1, axis=1)]
        return pdf.assign(intensity=np.exp(post @ grid), low=np.exp(low), converged=done)

    return grouped.groupBy(side).applyInPandas(fit, schema)


def bootstrap_rate(rows: DataFrame, by: list[str], hit: str, cluster: str, draws: int = 1000, seed: int = 7) -> DataFrame:
    """(by, rate, low, high): rate of ``hit`` with clusters resampled, as Poisson(1) weights per cluster and draw.

    Clusters are summed up first; weights come from a hash of cluster and draw, so the result doesn't
    depend on partitioning. Draws are an array per group: one pass, no replicated rows.
    """
    sums = rows.groupBy(*by, cluster).agg(F.sum(F.col(hit).cast("int")).alias("k"), F.count("*").alias("n"))

    def weigh(batches):
        for pdf in batches:
            out = []
            for key, part in pdf.groupby(by, dropna=False, sort=True):
                totals = np.zeros((2, draws + 1))
                for c, k, n in zip(part[cluster], part["k"], part["n"]):
                    u = np.random.default_rng([seed, hash_of(c)]).poisson(1.0, draws)
                    totals += np.array([[k], [n]]) * np.r_[1, u]
                out.append((*key, totals[0].tolist(), totals[1].tolist()))
            yield pd.DataFrame(out, columns=[*by, "ks", "ns"])

    def hash_of(v) -> int:
        import zlib

        return zlib.crc32(str(v).encode())

    kinds = ", ".join(f"{c} {t}" for c, t in sums.select(*by).dtypes)
    parts = sums.mapInPandas(weigh, kinds + ", ks array<double>, ns array<double>")
    at = parts.select(*by, F.posexplode(F.arrays_zip("ks", "ns")).alias("draw", "x")).groupBy(*by, "draw").agg(
        F.try_divide(F.sum("x.ks"), F.sum("x.ns")).alias("rate"))
    return at.groupBy(*by).agg(F.max(F.when(F.col("draw") == 0, F.col("rate"))).alias("rate"),
                               F.percentile(F.when(F.col("draw") > 0, F.col("rate")), 0.025).alias("low"),
                               F.percentile(F.when(F.col("draw") > 0, F.col("rate")), 0.975).alias("high"))
