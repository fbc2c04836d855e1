"""Ridge logistic regression by Newton steps, for calibrating a few features on the driver."""

from __future__ import annotations

import numpy as np


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 3e-3, steps: int = 40) -> tuple[np.ndarray, float]:
    """(weights, offset) for raw features; the penalty acts on standardised ones."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([(features - mean) / scale, np.ones(len(features))])
    n = len(labels)
    penalty = ridge * n * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6 * n
    w = np.zeros(x.shape[1])
    w[-1] = np.log((labels.sum() + 1) / (n - labels.sum() + 1))
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - labels) + penalty @ w
        curvature = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty
        step = np.linalg.solve(curvature, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
