"""Column-level helpers and the fixed constants of the entropy, PSI and report
rounding.  Every helper returns a Spark ``Column`` built from built-in
expressions, so it stays inside Catalyst and whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
ENTROPY_STD_FLOOR = 1e-8      # windows with population std below this have entropy 0
ENTROPY_LOG_EPS = 1e-10       # added inside the log of each bin share
ENTROPY_BINS = 4              # equal-width histogram bins
PSI_EPS = 1e-6                # outer-edge widening and zero-share replacement
PSI_BINS = 10                 # decile bins
ROUND_DIGITS = 5              # drift report rounding


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """The one place NaN becomes NULL (ingest); Spark aggregates skip NULL, not NaN."""
    c = col_(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division where a zero (or NULL) denominator gives NULL instead of an error."""
    return F.try_divide(col_(num), col_(den))


def ewma_decay(span: float) -> float:
    """pandas ``span`` parameterisation: alpha = 2/(span+1); returns 1 - alpha."""
    if span < 1:
        raise ValueError("span must be >= 1")
    return 1.0 - 2.0 / (span + 1.0)


def ewma_reach_rows(span: float) -> int:
    """Rows after which an observation's weight r^rows is 0.0 in a double."""
    r = ewma_decay(span)
    if r <= 0.0:
        return 1
    return int(math.ceil(745.2 / -math.log(r))) + 1


def ewma_max_exponent_rows(span: float, max_log: float = 600.0) -> int:
    """Longest run of rows whose power weights r^-q stay below e^max_log."""
    r = ewma_decay(span)
    if r <= 0.0:
        return 1 << 30
    return max(1, int(max_log / math.log(1.0 / r)))


def ks_asymptotic_pvalue(d: Column, n1: Column, n2: Column, terms: int = 30) -> Column:
    """Two-sided tail Q of the Kolmogorov distribution at lambda = D * sqrt(n1*n2/(n1+n2)).

    Above 1.18 the alternating series 2 sum (-1)^(k-1) e^(-2 k^2 lambda^2); below it, where
    that needs ever more terms, 1 - sqrt(2 pi)/lambda sum e^(-(2k-1)^2 pi^2 / (8 lambda^2)).
    Either branch has converged after a few terms; Q goes to 1 as lambda goes to 0."""
    lam = d * F.sqrt((n1 * n2).cast("double") / (n1 + n2).cast("double"))
    ks = F.sequence(F.lit(1), F.lit(terms))
    far = F.aggregate(
        ks,
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    near = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * F.aggregate(
        ks, F.lit(0.0), lambda acc, k: acc + F.exp(-(2 * k - 1) * (2 * k - 1) * F.lit(math.pi**2 / 8) / (lam * lam))
    )
    q = F.when(lam <= F.lit(0.0), F.lit(1.0)).when(lam < F.lit(1.18), near).otherwise(far)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))
