"""p-value helpers (NumPy). Shipped to executors by value, so no install is needed there."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _gammaincc(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above.

    Both need a number of terms near the square root of a; a value that has not settled
    within that (with a wide margin) is NaN, never a half-finished sum.
    """
    out = np.full(len(a), np.nan)
    for idx, (aa, xx) in enumerate(zip(a, x)):
        if not np.isfinite(xx) or not np.isfinite(aa) or aa <= 0:
            continue
        if xx <= 0:
            out[idx] = 1.0
            continue
        front = math.exp(-xx + aa * math.log(xx) - math.lgamma(aa)) if aa < 1e6 else _front(aa, xx)
        terms = 1000 + int(40 * math.sqrt(max(aa, xx)))
        out[idx] = 1.0 - front * _series(aa, xx, terms) if xx < aa + 1.0 else front * _fraction(aa, xx, terms)
    return np.clip(out, 0.0, 1.0)


def _front(a: float, x: float) -> float:
    """x^a e^-x / Gamma(a) by Stirling's formula, free of the cancellation between large logarithms."""
    d = (x - a) / a
    return math.sqrt(a / (2 * math.pi)) * math.exp(a * (math.log1p(d) - d) - 1 / (12 * a))


def _series(a: float, x: float, terms: int) -> float:
    total = term = 1.0 / a
    for k in range(1, terms):
        term *= x / (a + k)
        total += term
        if term < total * 1e-16:
            return total
    return math.nan


def _fraction(a: float, x: float, terms: int) -> float:
    """Modified Lentz evaluation of the continued fraction."""
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / (b or tiny)
    h = d
    for i in range(1, terms):
        an = -i * (i - a)
        b += 2.0
        d = 1.0 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            return h
    return math.nan


def chi2_sf_udf():
    @F.pandas_udf(T.DoubleType())
    def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(_gammaincc(dof.to_numpy(float) / 2.0, stat.to_numpy(float) / 2.0))

    return chi2_sf
