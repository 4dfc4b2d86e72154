"""Linear solvers on moment matrices. Small numpy helpers; no rows come here.

A matrix covers z = [1, x..., y]. Coefficients are (intercept, slopes).
"""

from __future__ import annotations

import warnings

import numpy as np

from ..session import runs_in_tasks


def centered(g: np.ndarray):
    """n, means, and the population covariance of [x..., y]."""
    n = g[0, 0]
    means = g[0, 1:] / n
    return n, means, g[1:, 1:] / n - np.outer(means, means)


def ridge(g: np.ndarray, alpha: float = 0.0):
    """Least squares with alpha * |b|^2 added to the sum of squares; alpha 0 is plain
    least squares, by pseudo-inverse where columns are collinear."""
    n, means, s = centered(g)
    sxx, sxy = s[:-1, :-1], s[:-1, -1]
    if alpha > 0:
        b = np.linalg.solve(sxx + np.eye(len(sxx)) * (alpha / n), sxy)
    else:
        # scale to unit variance so that the rank decision does not depend on units
        d = np.sqrt(np.clip(np.diag(sxx), 0, None))
        d[d == 0] = 1.0
        b = np.linalg.lstsq(sxx / np.outer(d, d), sxy / d, rcond=1e-12)[0] / d
    return means[-1] - means[:-1] @ b, b


def elastic_net(g: np.ndarray, alpha: float, l1_ratio: float, start=None,
                tolerance: float = 1e-10, sweeps: int = 20_000):
    """Minimizes mean squared error / 2 + alpha * (l1_ratio |b|_1 + (1 - l1_ratio) |b|^2 / 2)
    by coordinate descent on the covariances (Friedman, Hastie, Tibshirani 2010). Stops
    when no slope moves the fit by more than ``tolerance`` of the target's spread, or after ``sweeps`` with a warning."""
    _, means, s = centered(g)
    sxx, sxy, syy = s[:-1, :-1], s[:-1, -1], max(s[-1, -1], 0.0)
    diagonal = np.diag(sxx).copy()
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    b = np.zeros(len(sxy)) if start is None else np.array(start, dtype=float)
    residual = sxy - sxx @ b
    live = [j for j in range(len(b)) if diagonal[j] > 0]
    limit = tolerance * np.sqrt(syy)
    for _ in range(sweeps):
        moved = 0.0
        for j in live:
            old = b[j]
            rho = residual[j] + diagonal[j] * old
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diagonal[j] + l2)
            if new != old:
                residual -= sxx[:, j] * (new - old)
                b[j] = new
                moved = max(moved, abs(new - old) * np.sqrt(diagonal[j]))
        if moved <= limit:
            break
    else:
        warnings.warn(f"elastic net did not converge in {sweeps} sweeps; the last solution is returned", stacklevel=2)
    return means[-1] - means[:-1] @ b, b


def squared_error(g: np.ndarray, intercept: float, b: np.ndarray) -> float:
    """Mean squared error of a fit on the rows behind ``g``."""
    v = np.concatenate([[-intercept], -np.asarray(b), [1.0]])
    return max(float(v @ g @ v) / g[0, 0], 0.0)


def r_squared(g: np.ndarray, intercept: float, b: np.ndarray) -> float:
    spread = centered(g)[2][-1, -1]
    return 1.0 - squared_error(g, intercept, b) / spread if spread > 0 else float("nan")


runs_in_tasks(__name__)
