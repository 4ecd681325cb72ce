"""A linear support vector machine with squared hinge loss, for bounded samples."""

from __future__ import annotations

import numpy as np


def fit(rows: np.ndarray, positive: np.ndarray, penalty: float = 10.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of the widest soft margin between the two halves of ``rows``.

    Newton's method on the dual coefficients: the loss is quadratic in the rows
    inside the margin, so each round solves for those rows alone, until they no
    longer change. Work and memory are bounded by the square of the sample.
    """
    y = np.where(positive, 1.0, -1.0)
    full = np.hstack([rows, np.ones((len(rows), 1), rows.dtype)]).astype(np.float64)
    kernel = full @ full.T
    inside = np.ones(len(rows), bool)
    beta = np.zeros(len(rows))
    for _ in range(rounds):
        at = np.flatnonzero(inside)
        beta = np.zeros(len(rows))
        beta[at] = np.linalg.solve(kernel[np.ix_(at, at)] + np.eye(len(at)) / penalty, y[at])
        now = y * (kernel @ beta) < 1
        if not now.any() or (now == inside).all():
            break
        inside = now
    weights = full.T @ beta
    return weights[:-1], float(weights[-1])
