"""Linear support vector machines by dual coordinate descent, and a sigmoid for margins."""

from __future__ import annotations

import numpy as np

Row = tuple[np.ndarray, np.ndarray]


def fit_svm(
    rows: list[Row], labels: np.ndarray, size: int, *, cost: float = 1.0, epochs: int = 12
) -> np.ndarray:
    """Weights, and a bias as the last one, for sparse rows (indices, values) and labels +-1.

    Each step solves the hinge-loss dual for one row exactly. Deterministic.
    """
    weights = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    squares = np.array([float(values @ values) + 1.0 for _, values in rows])
    random = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            index, values = rows[i]
            gap = labels[i] * (weights[index] @ values + weights[size]) - 1.0
            now = min(max(alpha[i] - gap / squares[i], 0.0), cost)
            step = (now - alpha[i]) * labels[i]
            if step:
                weights[index] += step * values
                weights[size] += step
                alpha[i] = now
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """a and b such that 1 / (1 + exp(-(a * margin + b))) is likely for the labels."""
    ones, zeros = positive.sum(), len(positive) - positive.sum()
    goal = np.where(positive > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((np.logaddexp(0, z) - goal * z).sum() + 5e-4 * a * a)

    a, b = 0.0, float(np.log((ones + 1) / (zeros + 1)))
    for _ in range(100):
        p = sigmoid(a * margins + b)
        spread = p * (1 - p) + 1e-9
        gradient = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        cross = (spread * margins).sum()
        curve = np.array(
            [[(spread * margins * margins).sum() + 1e-3, cross], [cross, spread.sum() + 1e-6]]
        )
        step, now, size = np.linalg.solve(curve, gradient), loss(a, b), 1.0
        while size > 1e-8 and loss(a - size * step[0], b - size * step[1]) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if size * abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
