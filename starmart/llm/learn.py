"""Small linear models, fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(x * np.asarray(0.5, x.dtype))


def fit_logistic(
    x: np.ndarray,
    y: np.ndarray,
    l2: float = 1.0,
    steps: int = 300,
    intercept: bool = True,
    positive: float = 1.0,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression, by accelerated gradient descent.

    ``l2`` is the total penalty ``l2 / 2 * |w|^2`` beside the summed loss, in which a row of class 1
    counts ``positive`` times. With one class only the intercept says so.
    """
    # One type throughout, and a copy of the transpose: products stay plain matrix products.
    x, y = np.ascontiguousarray(x, np.float32), np.asarray(y, np.float32)
    across = np.ascontiguousarray(x.T)
    n, d = x.shape
    w, b = np.zeros(d, np.float32), 0.0
    if n == 0:
        return w.astype(float), b
    # The curvature is at most a quarter of the largest eigenvalue of the features, found by power steps.
    v = (np.ones(d + 1) / np.sqrt(d + 1)).astype(np.float32)
    for _ in range(20):
        u = x @ v[:d] + (v[d] if intercept else 0.0)
        v = np.append(across @ u, np.float32(u.sum() if intercept else 0.0))
        top = float(np.linalg.norm(v))
        v = v / top if top else v
    rate = np.float32(1.0 / (0.25 * 1.05 * max(1.0, positive) * top + l2 + 1e-9))
    counts = np.where(y > 0.5, positive, 1.0).astype(np.float32)
    z, zb, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = counts * (sigmoid(x @ z + np.float32(zb)) - y)
        new = z - rate * (across @ error + np.float32(l2) * z)
        new_b = zb - rate * float(error.sum()) if intercept else 0.0
        t_new = 0.5 * (1 + np.sqrt(1 + 4 * t * t))
        z, zb = new + np.float32((t - 1) / t_new) * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w.astype(float), float(b)
