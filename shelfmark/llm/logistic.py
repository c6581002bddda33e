"""Logistic regression of a bounded sample."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, np.ndarray | None]:
    """Intercept and slopes by Newton's method on standardised columns with a ridge; no slopes if
    only one label is there."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0, None
    mean, spread = x.mean(0), x.std(0)
    spread[spread == 0] = 1
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + penalty * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / spread
    return float(w[0] - (slopes * mean).sum()), slopes
