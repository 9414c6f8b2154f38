"""Small numpy optimiser for the models that are fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


def lbfgs(loss, x: np.ndarray, steps: int, memory: int = 8, tolerance: float = 1e-5) -> np.ndarray:
    """Minimise ``loss(x) -> (value, gradient)`` with limited-memory BFGS and backtracking."""
    value, grad = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.linalg.norm(grad) <= tolerance * max(1.0, np.linalg.norm(x)):
            break
        q, saved = grad.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            saved.append(a)
            q -= a * y
        if pairs:
            s, y, _ = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(grad))
        for (s, y, rho), a in zip(pairs, reversed(saved)):
            q += (a - rho * (y @ q)) * s
        slope, rate = grad @ q, 1.0
        while rate > 1e-6:
            new = x - rate * q
            new_value, new_grad = loss(new)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = new - x, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs[-memory + 1:], (s, y, 1 / (s @ y))]
        x, value, grad = new, new_value, new_grad
    return x
