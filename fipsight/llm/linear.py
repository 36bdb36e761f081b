"""Logistic regression on hashed sparse features, trained with follow-the-regularised-leader updates.

A training row holds its feature indexes below ``dims`` and their values. Weights live in one array
of ``dims`` entries, so a model has a fixed size, which is what is collected and broadcast.
"""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def ftrl_train(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, dims: int, alpha: float = 0.3,
               beta: float = 1.0, l1: float = 0.2, l2: float = 0.1, epochs: int = 3, seed: int = 7,
               keep: float = 1.0) -> np.ndarray:
    """Per-coordinate FTRL-proximal: z collects gradients corrected by the weight moved, n their
    squares; a weight is zero while |z| <= l1. Each row's indexes must be distinct; entry ``dims - 1``
    of every model is free for the caller's bias. With ``keep`` < 1 each visit of a row sees a random
    share of its features (never without its last one), so that no feature leans on its company."""
    z, n = np.zeros(dims), np.zeros(dims)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(index)).tolist():
            at, x = index[i], value[i]
            if keep < 1.0:
                some = rng.random(len(at)) < keep
                some[-1:] = True
                at, x = at[some], x[some]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
            g = (sigmoid(float(w @ x)) - label[i]) * x
            ni2 = ni + g * g
            z[at] = zi + g - (np.sqrt(ni2) - root) / alpha * w
            n[at] = ni2
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def pack_row(index: np.ndarray, value: np.ndarray) -> bytes:
    return index.astype("<i4").tobytes() + value.astype("<f4").tobytes()


def unpack_row(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 8
    return np.frombuffer(raw, "<i4", n).astype(np.int64), np.frombuffer(raw, "<f4", n, 4 * n).astype(np.float64)
