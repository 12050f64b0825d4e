"""The unit-root regression from sums of products, one small solve per series."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# The UDF body travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NOTHING = (None, None, None)


def _least(gram: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Residual sum of squares of the last column after 0, 1, ... regressors, and the triangle; regressors without own variation end it."""
    size = len(gram)
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    work, rss = gram * scale[:, None] * scale[None, :], []
    lower = np.zeros((size, size))
    for k in range(pivots):
        rss.append(work[-1, -1])
        if work[k, k] <= 1e-13:
            return np.array(rss) / scale[-1] ** 2, None
        lower[:, k] = work[:, k] / math.sqrt(work[k, k])
        lower[:k, k] = 0
        work = work - np.outer(lower[:, k], lower[:, k])
    return np.array([*rss, work[-1, -1]]) / scale[-1] ** 2, lower / scale[:, None]


def _fitted(n: int, cap: int, packed: np.ndarray, early: list) -> tuple:
    """Lag order, number of observations and statistic from sums of products of (1, level, change, lags) over the common sample and the rows before it."""
    width = int((math.sqrt(8 * len(packed) + 1) - 1) / 2)
    whole = np.zeros((width, width))
    whole[np.triu_indices(width)] = packed
    whole = whole + np.triu(whole, 1).T
    order = [0, 1, *range(3, 3 + cap), 2]  # the change is the target
    rows = n - 1 - cap
    if n < 4:
        return _NOTHING
    rss = np.maximum(_least(whole[np.ix_(order, order)], cap + 2)[0][2:], 1e-300)
    lags = int(np.argmin(rows * np.log(rss / rows) + 2 * np.arange(2, len(rss) + 2)))
    own = whole + sum((np.outer(x, x) for x in map(np.asarray, early[lags:])), np.zeros((width, width)))
    rows, pivots = n - 1 - lags, lags + 2
    if rows <= pivots:
        return _NOTHING
    order = [0, 1, *range(3, 3 + lags), 2]
    rest, lower = _least(own[np.ix_(order, order)], pivots)
    if lower is None or not rest[-1] > 1e-20 * own[2, 2]:
        return lags, rows, None
    left = np.linalg.inv(lower[:pivots, :pivots])
    slope = left[:, 1] @ lower[pivots, :pivots]
    return lags, rows, float(slope / (math.sqrt(rest[-1] / (rows - pivots)) * np.linalg.norm(left[:, 1])))


def unit_root_fit(n: Column, cap: Column, gram: Column, early: Column) -> Column:
    """lag_order, n_obs and adf_stat. gram: upper triangle of the sums, row by row; early: the vectors before the common sample, in order."""
    @F.pandas_udf("lag_order int, n_obs long, adf_stat double")
    def fit(n: pd.Series, cap: pd.Series, gram: pd.Series, early: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([_fitted(*row) for row in zip(n, cap, gram, early)], columns=["lag_order", "n_obs", "adf_stat"])
        return found.astype({"lag_order": "Int32", "n_obs": "Int64", "adf_stat": "float64"})

    return fit(n, cap, gram, early)
