"""A small logistic regression (numpy), fitted on the driver to a bounded sample."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Ridge logistic regression over standardised features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30):
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y[0]) if len(y) else 0.0
            return
        self.mean, self.dev = x.mean(0), np.maximum(x.std(0), 1e-9)
        a = np.column_stack([(x - self.mean) / self.dev, np.ones(len(x))])
        w = np.zeros(a.shape[1])
        penalty = np.full(a.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            grad = a.T @ (p - y) + penalty * w
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), grad)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def logit(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), 30.0 if self.constant else -30.0)
        return np.clip(((x - self.mean) / self.dev) @ self.weights[:-1] + self.weights[-1], -30, 30)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))
