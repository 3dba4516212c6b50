"""Exact two-sided p-value of the two-sample Kolmogorov-Smirnov test.

Under the null hypothesis every order of the pooled sample is equally likely: a walk
from (0, 0) to (n1, n2) that steps along one axis for each value.  The p-value is the
share of walks that reach a distance of at least D from the diagonal.  The walk's
probability is carried along anti-diagonals, inside the band only, and what leaves the
band is added up, so small p-values keep their digits.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest sample size of the exact mode (the automatic switch of the usual library).
EXACT_MAX = 10_000


def exact_pvalue(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for samples of n1 and n2 values; work n1 + n2 steps over the band."""
    m, n = max(n1, n2), min(n1, n2)
    if n == 0:
        return math.nan
    g = math.gcd(m, n)
    a, b = n // g, m // g  # a step along m moves by a, one along n by -b
    h = round(d * (m // g * n))
    if h <= 0:
        return 1.0
    total, outside = m + n, 0.0
    first, u = 0, np.ones(1)  # u[t]: probability of the point (first + t, k - first - t)
    for k in range(total):
        i = np.arange(first, first + len(u))
        rest = total - k
        low = max(0, k + 1 - n)
        high = min(m, k + 1)
        new = np.zeros(len(u) + 1)
        new[:-1] += u * ((n - (k - i)) / rest)
        new[1:] += u * ((m - i) / rest)
        i = np.arange(first, first + len(new))
        away = np.abs(i * a - (k + 1 - i) * b) >= h
        outside += float(new[away].sum())
        keep = np.flatnonzero(~away & (i >= low) & (i <= high))
        if not len(keep):
            break
        first, u = first + int(keep[0]), new[keep[0] : keep[-1] + 1]
    return min(max(outside, 0.0), 1.0)


def _pvalues(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_pvalue(x, int(p), int(q)) if max(p, q) <= EXACT_MAX else None for x, p, q in zip(d, n1, n2)], dtype="float64")


def ks_exact_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Column form, for tables of one row per test; NULL above EXACT_MAX values."""
    # executors need no copy of this module
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return F.pandas_udf(_pvalues, "double")(d, n1, n2)
