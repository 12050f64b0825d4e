"""Least-squares search over recursions along time, for many series at once.

Each time step handles a whole Arrow batch of series times all parameter sets
tried, in numpy. Spark decides which series meet in a batch.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# The UDF bodies travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PERIOD = 6
BATCH = 64


def _grid(*axes: list[float]) -> np.ndarray:
    return np.array(list(itertools.product(*axes))).T


# Weights of level, trend and season tried first, then how far each refinement looks around the best set: it may leave the first grid.
SMOOTHING_COARSE = _grid([0.02, 0.1, 0.3, 0.6], [0.0, 0.02, 0.1, 0.3], [0.02, 0.1, 0.3, 0.6])
SMOOTHING_STEPS = [0.16, 0.08, 0.04, 0.02, 0.01, 0.005]

# Coefficients φ, θ, Φ, Θ tried first, then the width of each refinement around the best set.
_OWN, _SHOCK, _SEASONAL = [-0.4, 0.0, 0.4, 0.8], [-0.95, -0.7, -0.4, 0.0, 0.4], [-0.4, 0.0, 0.4]
ARIMA_COARSE = {
    False: _grid(_OWN, _SHOCK, [0.0], [0.0]),
    True: _grid(_OWN, _SHOCK, _SEASONAL, _SHOCK[:4]),
}
ARIMA_STEPS = [(0.2, 0.15), (0.12, 0.09), (0.07, 0.05), (0.04, 0.03), (0.02, 0.015)]  # own, shock
LIMIT = 0.99


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), length.max()))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, length


def _smooth(y: np.ndarray, length: np.ndarray, weights: np.ndarray):
    """Additive trend and season: squared one-step errors and final states per (series, set)."""
    a, b, g = weights
    level = np.repeat(y[:, :PERIOD].mean(axis=1)[:, None], a.shape[1], axis=1)
    trend, sse = np.zeros_like(level), np.zeros_like(level)
    season = np.stack([y[:, i, None] - level for i in range(PERIOD)])
    for t in range(PERIOD, y.shape[1]):
        now, slot, live = y[:, t, None], t % PERIOD, (t < length)[:, None]
        ahead, old = level + trend, season[slot]
        miss = now - (ahead + old)
        sse = np.where(live, sse + miss * miss, sse)
        moved = a * (now - old) + (1 - a) * ahead
        trend = np.where(live, b * (moved - level) + (1 - b) * trend, trend)
        level = np.where(live, moved, level)
        season[slot] = np.where(live, g * (now - ahead) + (1 - g) * old, old)
    coming = np.stack([season[(length + i) % PERIOD, np.arange(len(y))] for i in range(PERIOD)])
    return sse, [level, trend, coming]


def _shocks(w: np.ndarray, length: np.ndarray, coefficients: np.ndarray):
    """Multiplicative ARMA on differenced values: squared shocks and the last ones, newest first."""
    phi, theta, phi_s, theta_s = coefficients
    keep = PERIOD + 2
    ring = np.zeros((keep, *phi.shape))
    sse = np.zeros(phi.shape)
    for t in range(w.shape[1]):
        live = (t < length)[:, None]

        def back(k: int):
            return w[:, t - k, None] if t >= k else 0.0

        shock = (
            back(0) - phi * back(1) - phi_s * (back(PERIOD) - phi * back(PERIOD + 1))
            - theta * ring[(t - 1) % keep]
            - theta_s * (ring[(t - PERIOD) % keep] + theta * ring[(t - PERIOD - 1) % keep])
        )
        ring[t % keep] = np.where(live, shock, ring[t % keep])
        if t > PERIOD:
            sse = np.where(live, sse + shock * shock, sse)
    newest = np.stack([ring[(length - k) % keep, np.arange(len(w))] for k in range(1, PERIOD + 2)])
    return sse, [newest]


def _search(run: Callable, data: np.ndarray, length: np.ndarray, coarse: np.ndarray, refinements: list[Callable], tie: float = 0.0):
    """Best set per series: the coarse grid, then each refinement around the best so far. Of errors within ``tie`` of the least, relatively, the first counts."""
    tries = np.repeat(coarse[:, None, :], len(data), axis=1)
    for refine in [None, *refinements]:
        if refine is not None:
            tries = refine(best)
        sse, states = run(data, length, tries)
        pick, rows = (sse <= sse.min(axis=1, keepdims=True) * (1 + tie)).argmax(axis=1), np.arange(len(data))
        best = tries[:, rows, pick]
    return best, sse[rows, pick], [s[..., rows, pick] for s in states]


def _around(step: np.ndarray, lowest: float = -LIMIT) -> Callable:
    offsets = _grid(*[[-s, 0.0, s] if s else [0.0] for s in step])
    return lambda best: np.clip(best[:, :, None] + offsets[:, None, :], lowest, LIMIT)


def _smoothing_rows(rows: list[np.ndarray]) -> dict[str, list]:
    y, length = _padded(rows)
    (a, b, g), sse, (level, trend, season) = _search(_smooth, y, length, SMOOTHING_COARSE, [_around([s] * 3, 0.0) for s in SMOOTHING_STEPS], tie=1e-9)
    return {"alpha": a, "beta": b, "gamma": g, "sse": sse, "level": level, "trend": trend, "season": list(season.T)}


def _arima_rows(seasonal: bool) -> Callable[[list[np.ndarray]], dict[str, list]]:
    def fit(rows: list[np.ndarray]) -> dict[str, list]:
        w, length = _padded(rows)
        steps = [np.array([own, shock, own * seasonal, shock * seasonal]) for own, shock in ARIMA_STEPS]
        (phi, theta, phi_s, theta_s), sse, (shocks,) = _search(
            _shocks, w, length, ARIMA_COARSE[seasonal], [_around(s) for s in steps])
        return {"ar": phi, "ma": theta, "seasonal_ar": phi_s, "seasonal_ma": theta_s, "sse": sse,
                "shocks": list(shocks.T)}

    return fit


def _batched(fit: Callable[[list[np.ndarray]], dict[str, list]], names: list[str], least: int):
    """A UDF body that fits the long enough arrays of a batch and leaves the others NULL."""
    def body(arrays: pd.Series) -> pd.DataFrame:
        out = {n: np.full(len(arrays), None, dtype=object) for n in names}
        usable = [i for i, h in enumerate(arrays) if h is not None and len(h) >= least]
        for start in range(0, len(usable), BATCH):
            part = usable[start : start + BATCH]
            fitted = fit([np.asarray(arrays.iloc[i], dtype=float) for i in part])
            for name in names:
                for place, value in zip(part, fitted[name]):
                    out[name][place] = value
        return pd.DataFrame(out)

    return body


def smoothing_fit(history: Column) -> Column:
    """Best weights and final states for an array of observations, NULL if under two seasons.

    ``season`` starts with the step after the last observation.
    """
    schema = "alpha double, beta double, gamma double, sse double, level double, trend double, season array<double>"
    names = ["alpha", "beta", "gamma", "sse", "level", "trend", "season"]
    return F.pandas_udf(_batched(_smoothing_rows, names, 2 * PERIOD), schema).asNondeterministic()(history)  # else filters on the result fit again


def arima_fit(differenced: Column, seasonal: bool) -> Column:
    """Least-squares ARMA(1,1), optionally times a seasonal ARMA(1,1), on differenced values.

    ``shocks`` holds the last ones, newest first. NULL if under two seasons.
    """
    schema = "ar double, ma double, seasonal_ar double, seasonal_ma double, sse double, shocks array<double>"
    names = ["ar", "ma", "seasonal_ar", "seasonal_ma", "sse", "shocks"]
    return F.pandas_udf(_batched(_arima_rows(seasonal), names, 2 * PERIOD), schema).asNondeterministic()(differenced)  # else filters on the result fit again
