"""Tail probabilities, vectorised with NumPy for use inside Arrow batches."""

from __future__ import annotations

import math

import numpy as np

_erfc = np.frompyfunc(math.erfc, 1, 1)


def chi2_tail_1df(stat: np.ndarray) -> np.ndarray:
    """P(X > stat) for one degree of freedom."""
    stat = np.asarray(stat, dtype=float)
    out = _erfc(np.sqrt(np.maximum(stat, 0.0) / 2.0)).astype(float)
    return np.where(np.isnan(stat), np.nan, out)


def _incomplete_beta(a: float, b: float, x: np.ndarray, steps: int = 400) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction, evaluated where it converges
    fast (x below the mean) and mirrored elsewhere by the caller."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = c * d
            h = h * delta
        if np.all(np.abs(delta - 1.0) < 4e-15):
            break
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    with np.errstate(divide="ignore"):
        front = np.exp(log_front + a * np.log(x) + b * np.log1p(-x))
    return front * h / a


def f_tail_1df(stat: np.ndarray, df: float) -> np.ndarray:
    """P(F > stat) for (1, df) degrees of freedom."""
    stat = np.asarray(stat, dtype=float)
    a, b = df / 2.0, 0.5
    f = np.where(np.isnan(stat), 0.0, np.maximum(stat, 0.0))
    x, y = df / (df + f), f / (df + f)
    low = x < (a + 1.0) / (a + b + 2.0)
    direct = _incomplete_beta(a, b, np.where(low, x, 0.5 * a / (a + b)))
    mirrored = 1.0 - _incomplete_beta(b, a, np.where(low, 0.5 * b / (a + b), y))
    return np.where(np.isnan(stat), np.nan, np.where(low, direct, mirrored))
