"""Beta distribution function and quantile as vectorised UDFs.

Spark has no incomplete beta function. The UDFs work on Arrow batches of
(alpha, beta, x) columns and are applied to one row per trial, never to events.

Where both parameters are large, the density is integrated over the tail by
Gauss-Legendre nodes; elsewhere the continued fraction is used. Both start from
a density written in deviations from the mean, so that no digits are lost in
differences of large logarithms. A row whose fraction has not settled is NULL.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# The UDF bodies travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_TINY = 1e-300
_LARGE = 1000.0  # from here on for both parameters, the tail is integrated
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(128)
_REACH = 14.0  # standard deviations beyond which a tail's density is nothing
_ROUNDS = 20_000  # the fraction settles in far fewer where one parameter is below _LARGE


def _log1p_less(x: np.ndarray) -> np.ndarray:
    """ln(1 + x) - x, without cancellation near 0."""
    small = np.abs(x) < 0.01
    s = np.where(small, x, 0.0)
    series = s * s * (-1 / 2 + s * (1 / 3 + s * (-1 / 4 + s * (1 / 5 + s * (-1 / 6 + s * (1 / 7 - s / 8))))))
    safe = np.maximum(np.where(small, 0.0, x), -1 + 1e-16)
    return np.where(small, series, np.log1p(safe) - safe)


def _correction(x: np.ndarray) -> np.ndarray:
    """What Stirling's formula for ln Γ(x) leaves out, for x of 10 or more."""
    y = 1 / (x * x)
    return (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / x


def _ln_kernel(p: np.ndarray, q: np.ndarray, z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """ln(z^p · w^q / B(p, q)) for z + w = 1."""
    total = p + q
    mean = p / total
    wide = np.minimum(p, q) >= 10
    big_p, big_q = np.maximum(p, 10), np.maximum(q, 10)
    away = np.where(z < 0.5, z - mean, q / total - w)
    spread = p * _log1p_less(away / mean) + q * _log1p_less(-away * total / q)
    centred = spread + 0.5 * (np.log(mean) + np.log(q) - math.log(2 * math.pi)) - (
        _correction(big_p) + _correction(big_q) - _correction(big_p + big_q))
    # One parameter is small: no term grows with the other one.
    low, high = np.minimum(p, q), np.maximum(p, q)
    high_10 = np.maximum(high, 10)
    uneven = _lgamma(low) + _correction(high_10) - _correction(low + high_10) + low - low * np.log(low + high) + (high - 0.5) * np.log1p(-low / (low + high))
    both = _lgamma(low) + _lgamma(np.minimum(high, 10)) - _lgamma(low + np.minimum(high, 10))
    ln_z = np.where(z < 0.5, np.log(np.maximum(z, _TINY)), np.log1p(-np.minimum(w, 0.5)))
    ln_w = np.where(w < 0.5, np.log(np.maximum(w, _TINY)), np.log1p(-np.minimum(z, 0.5)))
    return np.where(wide, centred, p * ln_z + q * ln_w - np.where(high >= 10, uneven, both))


def _by_nodes(p: np.ndarray, q: np.ndarray, z: np.ndarray) -> np.ndarray:
    """P(θ ≤ z) for z up to about the mean."""
    total = p + q
    sd = np.sqrt(p / total * (q / total) / (total + 1))
    half = np.minimum(_REACH * sd, z)[:, None] / 2
    at = z[:, None] - half + half * _NODES
    density = _ln_kernel(p[:, None], q[:, None], at, 1 - at) - np.log(np.maximum(at, _TINY)) - np.log1p(-at)
    return (half * np.exp(density) * _WEIGHTS).sum(1)


def _by_fraction(p: np.ndarray, q: np.ndarray, z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """P(θ ≤ z) for z up to about the mean; NaN where the fraction has not settled."""
    def unzero(v):
        return np.where(np.abs(v) < _TINY, _TINY, v)

    ratio = 1 / unzero(1 - (p + q) * z / (p + 1))
    value, product = ratio.copy(), np.ones_like(z)
    settled = np.zeros(len(z), bool)
    for m in range(1, _ROUNDS):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        change = np.ones_like(z)
        for term in (even, odd):
            ratio = 1 / unzero(1 + term * ratio)
            product = unzero(1 + term / product)
            change = ratio * product
            value = np.where(settled, value, value * change)
        settled |= np.abs(change - 1) < 1e-15
        if settled.all():
            break
    return np.where(settled, np.exp(_ln_kernel(p, q, z, w)) / p * value, np.nan)


def _cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray, upper: bool = False) -> np.ndarray:
    """P(θ ≤ x), or P(θ > x): the smaller tail is computed, the other is its complement."""
    swap = x > (a + 1) / (a + b + 2)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    inner = np.clip(x, _TINY, 1.0)
    z, w = np.where(swap, 1 - inner, inner), np.where(swap, inner, 1 - inner)
    z = np.maximum(z, _TINY)
    area = np.empty_like(z)
    large = np.minimum(p, q) >= _LARGE
    area[large] = _by_nodes(p[large], q[large], z[large])
    area[~large] = _by_fraction(p[~large], q[~large], z[~large], w[~large])
    out = np.where(swap != upper, 1 - area, area)
    return np.where(x <= 0, float(upper), np.where(x >= 1, float(not upper), out))


def _sf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _cdf(a, b, x, upper=True)


def _quantile(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    low, high = np.zeros_like(p), np.ones_like(p)
    unknown = np.zeros(len(p), bool)
    for _ in range(56):
        middle = (low + high) / 2
        reached = _cdf(a, b, middle)
        unknown |= np.isnan(reached)
        below = reached < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return np.where(unknown, np.nan, (low + high) / 2)


def _udf(body):
    def batch(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
        known = (a.notna() & b.notna() & x.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        if known.any():
            out[known] = body(*(s.to_numpy(dtype=float)[known] for s in (a, b, x)))
        return pd.Series(out)

    return batch


def beta_cdf(alpha: Column, beta: Column, x: Column) -> Column:
    """P(θ ≤ x) for θ ~ Beta(alpha, beta)."""
    return F.pandas_udf(_udf(_cdf), "double")(alpha.cast("double"), beta.cast("double"), x.cast("double"))


def beta_sf(alpha: Column, beta: Column, x: Column) -> Column:
    """P(θ > x) for θ ~ Beta(alpha, beta), with all digits where it is small."""
    return F.pandas_udf(_udf(_sf), "double")(alpha.cast("double"), beta.cast("double"), x.cast("double"))


def beta_quantile(alpha: Column, beta: Column, p: Column) -> Column:
    """The x with P(θ ≤ x) = p for θ ~ Beta(alpha, beta)."""
    return F.pandas_udf(_udf(_quantile), "double")(alpha.cast("double"), beta.cast("double"), p.cast("double"))
