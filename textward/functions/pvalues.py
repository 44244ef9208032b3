"""p-values of the two drift tests, as built-in expressions of one formula for every size.

`ks_exact_p_value` counts lattice paths instead; it is only used where it is asked for.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The series' terms fall below 1e-30 from here on, for every argument that it is used for.
KS_TERMS = 30
GAMMA_TERMS = 160
# Below the first value the tail is 1 up to 1e-12; beyond the second one it is under 1e-20.
LEAST_LAMBDA = 0.2
MOST_HALF = 50.0
_GONE = 2.0**1000


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p-value of the two-sample statistic ``d``: Kolmogorov's series at the effective size."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    scaled = d * d * (n1 * n2 / (n1 + n2))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled),
    )
    tail = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(scaled < LEAST_LAMBDA**2, 1.0).otherwise(
        F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0))
    )


def _path_leaves(gap: int, n1: int, n2: int) -> float:
    """Chance that a random order of n1 and n2 values has a gap of at least ``gap`` / (n1 * n2).

    An order is a path from (0, 0) to (n1, n2). ``left[i + 1]`` is the chance that a path through
    (i, k - i) has left the band by then; a step weighs its two predecessors by how many paths come
    from each. One diagonal after the other, n1 + n2 in all, and of each only the part inside the
    band: 2 * gap / (n1 + n2) numbers, outside of which all paths have left it.
    """
    if n1 > n2:
        n1, n2 = n2, n1
    if gap <= 0:
        return 1.0
    if _below_doubles(gap, n1, n2):
        return 0.0
    n = n1 + n2
    i = np.arange(n1 + 1, dtype=np.float64)
    # In units of 2^-1000: numbers below the normal doubles are slow, and the smallest don't vanish.
    left = np.full(n1 + 2, _GONE)
    left[1] = 0.0
    first, second = np.empty(n1 + 1), np.empty(n1 + 1)
    before = 0
    for k in range(1, n + 1):
        lo = max(0, k - n2, (k * n1 - gap) // n + 1)
        hi = min(n1, k, (k * n1 + gap - 1) // n) + 1
        if lo >= hi:
            return 1.0
        at, a, b = i[lo:hi], first[: hi - lo], second[: hi - lo]
        np.multiply(left[lo:hi], at, out=a)
        np.subtract(float(k), at, out=b)
        b *= left[lo + 1 : hi + 1]
        a += b
        np.divide(a, float(k), out=left[lo + 1 : hi + 1])
        left[before + 1 : lo + 1] = _GONE
        before = lo
    return float(left[n1 + 1]) / _GONE


def _below_doubles(gap: int, n1: int, n2: int) -> bool:
    """Whether the chance rounds to 0 as a double.

    One of the samples is off by its share of the gap then, which is bounded for each by 2 exp(-2 n
    share^2) (Massart); the shares are chosen to make both bounds equal.
    """
    share = gap / (n1 * n2) / (math.sqrt(n1) + math.sqrt(n2))
    return math.log(4) - 2 * n1 * n2 * share * share < -1076 * math.log(2)


def ks_exact_p_value(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p-value of the statistic ``d`` under continuous values, by counting lattice paths.

    A row takes 2 * n1 * n2 * d steps and min(n1, n2) numbers of memory. Where the p-value is above
    the least double, d is below 39 * (n1 ** -0.5 + n2 ** -0.5), so the steps grow with the power
    1.5 of the samples at most. Null if a sample is empty.
    """

    @F.pandas_udf("double")
    def p_value(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        rows = zip(d, n1, n2)
        return pd.Series(
            [_path_leaves(round(x * a * b), int(a), int(b)) if a and b else None for x, a, b in rows],
            dtype="float64",
        )

    return p_value(d, n1, n2)


def chi2_p_value(x: Column) -> Column:
    """Upper tail of the chi-square distribution with 3 degrees of freedom, by the gamma series."""
    half = F.least(x / 2, F.lit(MOST_HALF))
    logs = F.array(*[F.lit(math.lgamma(n + 2.5)) for n in range(GAMMA_TERMS)])
    terms = F.transform(logs, lambda g, n: F.exp((n + 1.5) * F.ln(half) - half - g))
    below = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(x <= 0, 1.0).otherwise(F.greatest(1.0 - below, F.lit(0.0)))
