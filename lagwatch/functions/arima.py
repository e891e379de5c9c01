"""One-step ARIMA forecasts by two-stage least squares (Hannan and Rissanen, 1982).

For every row the model is fitted on the rows before it only. All fits of a block are solved
together as one stack of small normal equations.
"""

from __future__ import annotations

from math import comb

import numpy as np

SIGMAS_AT_FULL_SCORE = 6.0
_BATCH = 1024
_TINY = 1e-9


def _solve(design: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Least-squares coefficients of a stack: (m, n, k), (m, n) -> (m, k)."""
    transposed = design.transpose(0, 2, 1)
    gram = transposed @ design
    moment = (transposed @ target[..., None])[..., 0]
    scale = np.trace(gram, axis1=1, axis2=2) / gram.shape[1]
    ridge = (1e-10 * scale + 1e-30)[:, None, None] * np.eye(gram.shape[1])
    return np.linalg.solve(gram + ridge, moment[..., None])[..., 0]


def _design(series: list[np.ndarray], lags: list[list[int]], start: int, stop: int) -> np.ndarray:
    """Intercept plus the lagged columns of each series for the targets start..stop-1."""
    m = series[0].shape[0]
    columns = [np.ones((m, stop - start))]
    for values, steps in zip(series, lags):
        columns += [values[:, start - k : stop - k] for k in steps]
    return np.stack(columns, axis=2)


def forecast_next(windows: np.ndarray, p: int, d: int, q: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Prediction of the value after each window, and the residual deviation of the fit."""
    level = np.mean(windows, axis=1, keepdims=True)
    spread = np.max(np.abs(windows - level), axis=1, keepdims=True)
    unit = np.where(spread > 0, spread, 1.0)
    scaled = (windows - level) / unit
    w = np.diff(scaled, n=d, axis=1) if d else scaled
    n = w.shape[1]

    long_order = min(max(p, q) + q + 2, n // 4)
    ar_lags = sorted({*range(1, p + 1), *([s] if s else [])})
    if q:
        steps = list(range(1, long_order + 1))
        first = _design([w], [steps], long_order, n)
        fitted = np.einsum("mnk,mk->mn", first, _solve(first, w[:, long_order:]))
        residuals = np.zeros_like(w)
        residuals[:, long_order:] = w[:, long_order:] - fitted
        series, lags = [w, residuals], [ar_lags, list(range(1, q + 1))]
        start = max(long_order + q, max(ar_lags, default=0))
    else:
        series, lags, start = [w], [ar_lags], max(ar_lags, default=0)

    design = _design(series, lags, start, n)
    coefficients = _solve(design, w[:, start:])
    errors = w[:, start:] - np.einsum("mnk,mk->mn", design, coefficients)
    freedom = max(1, design.shape[1] - design.shape[2])
    sigma = np.sqrt(np.sum(errors**2, axis=1) / freedom)

    latest = [np.ones((w.shape[0], 1))]
    for values, steps in zip(series, lags):
        latest += [values[:, n - k : n - k + 1] for k in steps]
    ahead = np.einsum("mk,mk->m", np.concatenate(latest, axis=1), coefficients)
    for i in range(1, d + 1):
        ahead = ahead + (-1) ** (i + 1) * comb(d, i) * scaled[:, -i]
    return ahead * unit[:, 0] + level[:, 0], sigma * unit[:, 0]


def score(actual: np.ndarray, predicted: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """|z| / 6 capped at 1; a fit without residuals scores 0 on a hit and 1 on a miss."""
    miss = np.abs(actual - predicted)
    size = 1.0 + np.abs(predicted)
    exact = sigma <= _TINY * size
    z = np.divide(miss, sigma, out=np.zeros_like(miss), where=~exact)
    out = np.minimum(1.0, z / SIGMAS_AT_FULL_SCORE)
    return np.where(exact, np.where(miss <= 1e-6 * size, 0.0, 1.0), out)


def detect_series(
    values: np.ndarray, p: int, d: int, q: int, s: int, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Score and prediction of every value of an ordered series; NaN during the warm-up."""
    values = np.asarray(values, dtype=float)
    scores = np.full(len(values), np.nan)
    predictions = np.full(len(values), np.nan)
    if len(values) <= window:
        return scores, predictions
    windows = np.lib.stride_tricks.sliding_window_view(values[:-1], window)
    for at in range(0, len(windows), _BATCH):
        ahead, sigma = forecast_next(windows[at : at + _BATCH], p, d, q, s)
        rows = slice(window + at, window + at + len(ahead))
        predictions[rows] = ahead
        scores[rows] = score(values[rows], ahead, sigma)
    return scores, predictions
