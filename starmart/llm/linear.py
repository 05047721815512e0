"""Linear classifiers fitted with numpy on a bounded, standardised sample; full-batch Adam steps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class LinearModel:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center) / self.scale) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x)).astype(float)


def fit_linear(x: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], l2: float = 1e-4, steps: int = 300, rate: float = 0.05,
               standardise: bool = True) -> LinearModel:
    """``gradient`` gives the derivative of the mean risk by each row's logit."""
    n, d = x.shape
    center = x.mean(0) if standardise and n else np.zeros(d)
    scale = x.std(0) + 1e-6 if standardise and n else np.ones(d)
    z = ((x - center) / scale).astype(np.float32)
    w, b = np.zeros(d), 0.0
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1 if n else 1):
        g = gradient(z @ w.astype(np.float32) + b)
        full = np.append(g.astype(np.float32) @ z + l2 * w, g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return LinearModel(center, scale, w, float(b))
