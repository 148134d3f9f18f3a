"""Statistics as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PSI_EPSILON = 1e-6  # fixed value, added to each fraction


def psi_term(base_fraction: Column, current_fraction: Column) -> Column:
    b = base_fraction + F.lit(PSI_EPSILON)
    c = current_fraction + F.lit(PSI_EPSILON)
    return (c - b) * F.ln(c / b)


def exact_ks_pvalue(d: float, n: int, m: int) -> float:
    """P(D >= d) when both samples come from one continuous distribution.

    Merging the samples is a random lattice path from (0, 0) to (n, m); p is the probability that
    it touches a point with |i/n - j/m| >= d.  Points are visited by antidiagonals: (i, j) is
    reached over (i-1, j) with probability i/(i+j).  All terms are positive, so small values keep
    their relative accuracy.
    """
    reach = round(d * n * m)
    if reach <= 0:
        return 1.0
    i = np.arange(n + 1, dtype=np.int64)
    touched = np.zeros(n + 1)
    for s in range(1, n + m + 1):
        step = i / s
        before = np.concatenate([[0.0], touched[:-1]])
        touched = step * before + (1.0 - step) * touched
        touched[np.abs(i * m - (s - i) * n) >= reach] = 1.0
        # Points off the grid are never read with weight; keep them finite.
        touched[i > s] = 0.0
    return float(min(max(touched[n], 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def _exact_ks_pvalues(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_pvalue(*row) for row in zip(d, n, m)], dtype="float64")


def ks_pvalue(d: Column, n: Column, m: Column, method: str = "asymptotic") -> Column:
    """``asymptotic`` or ``exact``, for samples of any size: the caller says which.  The exact form takes a number
    of steps that grows with the sample sizes, for each monitored column."""
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown p-value method {method!r}")
    return _exact_ks_pvalues(d, n, m) if method == "exact" else asymptotic_ks_pvalue(d, n, m)


def asymptotic_ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value with Stephens' small-sample correction.

    p = 2 * sum over k >= 1 of (-1)^(k-1) * exp(-2 k^2 x^2), x = (sqrt(e) + 0.12 + 0.11/sqrt(e)) * d,
    e = n*m / (n+m).  The series does not converge near x = 0, where p is 1.
    """
    n, m = n.cast("double"), m.cast("double")
    root = F.sqrt(n * m / (n + m))
    x = (root + F.lit(0.12) + F.lit(0.11) / root) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    bounded = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when((n == 0) | (m == 0), F.lit(1.0)).when(x < 0.2, F.lit(1.0)).otherwise(bounded)
