"""Tail probabilities of test statistics, for the few rows of a drift report."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Values in a group up to which paths are counted: 10^8 steps at most.
EXACT = 10_000


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def kolmogorov_two_sample(d: float, n: float, m: float) -> float:
    """Asymptotic tail of the two-sample statistic with the usual small-sample correction."""
    root = math.sqrt(n * m / (n + m))
    x = (root + 0.12 + 0.11 / root) * d
    if x < 0.2:
        return 1.0
    series = sum((-1) ** (k - 1) * math.exp(-2.0 * (k * x) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * series))


def kolmogorov_exact(d: float, n: int, m: int) -> float:
    """Share of the orders of ``n`` and ``m`` values whose two-sample statistic is ``d`` at least.

    An order is a lattice path from (0, 0) to (n, m), and its statistic the largest distance from the diagonal.  The paths
    that stay below ``d`` are counted row by row; each row is scaled, and the logarithm of the scales kept.
    """
    if n > m:
        n, m = m, n
    reach = round(d * n * m)  # the statistic is a multiple of 1 / (n m)
    if reach <= 0:
        return 1.0

    def inside(i: int) -> tuple[int, int]:
        return max(0, (i * m - reach) // n + 1), min(m, -((-i * m - reach) // n) - 1)

    lo, hi = inside(0)
    paths, scale = np.ones(hi - lo + 1), 0.0
    for i in range(1, n + 1):
        a, b = inside(i)
        if b < a:
            return 1.0
        row = np.zeros(b - a + 1)
        shared = paths[a - lo : min(hi, b) - lo + 1]
        row[: len(shared)] = shared
        paths, lo, hi = np.cumsum(row), a, b
        most = paths[-1]
        if most == 0:
            return 1.0
        paths, scale = paths / most, scale + math.log(most)
    if hi < m:
        return 1.0
    total = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(paths[-1]) + scale - total)))


def kolmogorov(d: float, n: float, m: float) -> float:
    """Tail of the two-sample statistic: exact where both groups have at most ``EXACT`` values, else asymptotic."""
    if max(n, m) <= EXACT:
        return kolmogorov_exact(d, int(n), int(m))
    return kolmogorov_two_sample(d, n, m)


def chi_square_tail(x: float, dof: float) -> float:
    """Regularised upper incomplete gamma function of (dof / 2, x / 2)."""
    if x <= 0 or dof <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, t = dof / 2.0, x / 2.0
    scale = math.exp(-t + a * math.log(t) - math.lgamma(a))
    if t < a + 1.0:
        term = total = 1.0 / a
        k = a
        while term > total * 1e-16:
            k += 1.0
            term *= t / k
            total += term
        return max(0.0, 1.0 - scale * total)
    # Continued fraction, evaluated from the front by Lentz's method.
    tiny = 1e-300
    b = t + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    value = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b or tiny)
        c = b + step / c or tiny
        value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return scale * value


@F.pandas_udf(DoubleType())
def p_value(method: pd.Series, statistic: pd.Series, n: pd.Series, m: pd.Series, dof: pd.Series) -> pd.Series:
    """p-value of the named test; NULL for a method which is a distance."""

    def one(name, x, size_n, size_m, freedom):
        if name == "K-S p_value":
            return kolmogorov(x, size_n, size_m)
        if name == "chi-square p_value":
            return chi_square_tail(x, freedom)
        if name == "Z-test p_value":
            return normal_two_sided(x)
        return None

    return pd.Series([one(*row) for row in zip(method, statistic, n, m, dof)], dtype="float64")
