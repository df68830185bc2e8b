"""Special functions on numpy arrays (no scipy), and their pandas UDFs."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

#: Coefficients of the Lanczos approximation (g = 7, n = 9).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def gammaln(x) -> np.ndarray:
    """log Gamma for positive arguments."""
    x = np.asarray(x, float)
    small = x < 0.5
    z = np.where(small, 1 - x, x) - 1
    total = np.full(z.shape, LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + c / (z + k)
    t = z + 7.5
    out = 0.5 * np.log(2 * np.pi) + (z + 0.5) * np.log(t) - t + np.log(total)
    with np.errstate(divide="ignore", invalid="ignore"):
        mirrored = np.log(np.pi / np.abs(np.sin(np.pi * x))) - out
    return np.where(small, mirrored, out)


def digamma(x) -> np.ndarray:
    """Recurrence up to 12, then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros(x.shape)
    for _ in range(12):
        low = x < 12
        out = out - np.where(low, 1 / x, 0)
        x = np.where(low, x + 1, x)
    i = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i / 252))


def poisson_cdf(n, mean) -> np.ndarray:
    """P(X <= n), the upper incomplete gamma ratio of n + 1: a series below the mode, a continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(n, float) + 1, np.asarray(mean, float))
    shape, a, x = a.shape, a.ravel(), x.ravel()
    out = np.ones(a.size)
    lead = np.exp(np.where(x > 0, -x + a * np.log(np.where(x > 0, x, 1)) - gammaln(a), -np.inf))
    low = np.flatnonzero((x > 0) & (x < a + 1))
    if len(low):
        term = total = 1 / a[low]
        k = a[low].copy()
        for _ in range(20_000):
            k += 1
            term = term * x[low] / k
            total = total + term
            if (term < total * 1e-16).all():
                break
        out[low] = 1 - lead[low] * total
    high = np.flatnonzero(x >= a + 1)
    if len(high):
        ah, xh = a[high], x[high]
        b = xh + 1 - ah
        c, d = np.full(len(high), 1e300), 1 / b
        h = d.copy()
        for k in range(1, 20_000):
            an = -k * (k - ah)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + an / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            h = h * d * c
            if (np.abs(d * c - 1) < 1e-15).all():
                break
        out[high] = lead[high] * h
    return np.clip(out, 0, 1).reshape(shape)


def gamma_cdf(shape, x) -> np.ndarray:
    """Regularised lower incomplete gamma for whole shapes: one minus a Poisson CDF."""
    return 1 - poisson_cdf(np.asarray(shape, int) - 1, x)


def gamma_quantile(shape, rate, p: float, steps: int = 60) -> np.ndarray:
    """Quantile of Gamma(shape, rate) for whole shapes: Newton steps on the CDF, kept inside a shrinking bracket.

    The start is the cube of a normal (Wilson and Hilferty); each shape is solved once.
    """
    shapes, where = np.unique(np.asarray(shape, int), return_inverse=True)
    a = shapes.astype(float)
    z = NormalDist().inv_cdf(p)
    lo, hi = np.zeros(len(a)), a + 12 * np.sqrt(a) + 30.0
    x = np.clip(a * (1 - 1 / (9 * a) + z / (3 * np.sqrt(a))) ** 3, 1e-6, hi)
    for _ in range(steps):
        off = gamma_cdf(shapes, x) - p
        lo, hi = np.where(off < 0, x, lo), np.where(off < 0, hi, x)
        slope = np.exp((a - 1) * np.log(x) - x - gammaln(a))
        new = x - off / np.maximum(slope, 1e-300)
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        done = np.abs(new - x) <= 1e-14 * x
        x = new
        if done.all():
            break
    return x[where].reshape(np.shape(shape)) / np.asarray(rate, float)


def nb_logpmf(y, mean, size) -> np.ndarray:
    """Negative binomial with the given mean and size (dispersion)."""
    y, mean, size = (np.asarray(v, float) for v in (y, mean, size))
    return (gammaln(y + size) - gammaln(size) - gammaln(y + 1) + size * np.log(size / (size + mean))
            + y * np.log(mean / (size + mean)))


def excess_udf(ratio: float = 3.0):
    """(n, E) -> struct: posterior mean rate ratio, 90 % interval and P(ratio >= ``ratio``)."""

    @F.pandas_udf("mean double, low double, high double, p double")
    def run(n: pd.Series, expected: pd.Series) -> pd.DataFrame:
        a, b = n.to_numpy(int) + 1, expected.to_numpy(float) + 1
        return pd.DataFrame({"mean": a / b, "low": gamma_quantile(a, b, 0.05), "high": gamma_quantile(a, b, 0.95),
                             "p": poisson_cdf(a - 1, ratio * b)})

    return run
