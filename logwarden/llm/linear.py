"""Linear models on small dense samples; numpy on the driver."""

from __future__ import annotations

import numpy as np


def fit_linear(x: np.ndarray, y: np.ndarray, hinge: bool, steps: int = 400, decay: float = 5e-4, rate: float = 3.0) -> tuple[np.ndarray, float]:
    """Weights and offset by gradient descent with momentum on the whole sample.

    ``hinge``: y is -1 or 1 and the loss the squared hinge of a linear support vector machine.  Otherwise y is a
    probability and the loss that of logistic regression.  Columns are scaled by their spread; the weights undo that.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0)
    scale = 1 / np.where(spread > 1e-9, spread, np.inf)
    z = (x - mean) * scale / np.sqrt(max(x.shape[1], 1))
    probe = np.ones(x.shape[1], x.dtype)
    for _ in range(20):  # the steepest direction bounds the step
        probe = z.T @ (z @ probe) / len(y)
        top = float(np.linalg.norm(probe))
        probe = probe / max(top, 1e-12)
    rate = min(rate, 1 / ((2.0 if hinge else 0.25) * (top + 1)))
    w, b, vw, vb = np.zeros(x.shape[1], x.dtype), 0.0, 0.0, 0.0
    for _ in range(steps):
        margin = z @ w + b
        slope = -2 * y * np.maximum(0, 1 - y * margin) if hinge else 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        vw = 0.9 * vw - rate * (z.T @ slope / len(y) + decay * w)
        vb = 0.9 * vb - rate * float(slope.mean())
        w, b = w + vw, b + vb
    w = w * scale / np.sqrt(max(x.shape[1], 1))
    return w.astype(np.float64), float(b - mean @ w)
