"""Leading eigenpairs of a symmetric matrix: Householder reduction, Sturm counts, inverse iteration.

The matrix has one row for each dimension of a vector, never for each vector, so this runs wherever the matrix is.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
# eigenvalues closer than this part of the matrix' norm form a cluster, whose vectors are kept orthogonal
CLUSTER = 1e-3
INVERSE_ROUNDS = 5


def tridiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of the tridiagonal matrix that a symmetric one is similar to.

    Reflector k has unit length, or none where there is nothing to do, and leaves the first k + 1 coordinates alone.
    """
    a = np.array(matrix, dtype=float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        below = a[k + 1 :, k]
        norm = np.linalg.norm(below)
        v = below.copy()
        v[0] += np.copysign(norm, v[0])
        length = np.linalg.norm(v)
        if length == 0 or np.linalg.norm(below[1:]) == 0:
            reflectors.append(np.zeros(n - k - 1))
            continue
        v /= length
        reflectors.append(v)
        # the trailing block from both sides, as one symmetric update
        block = a[k + 1 :, k + 1 :]
        p = 2.0 * (block @ v)
        w = p - (v @ p) * v
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2.0 * (v @ below) * v
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflectors


def above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are larger than each shift, by the signs of the Sturm sequence."""
    tiny = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0.0)))
    counts = np.zeros(len(shifts), dtype=int)
    q = np.ones(len(shifts))
    for i, d in enumerate(diagonal):
        q = d - shifts - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        counts += q > 0
    return counts


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until its bracket is as narrow as numbers allow."""
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    bottom, top = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = EPS * len(diagonal) * max(abs(bottom), abs(top)) + np.finfo(float).tiny
    low, high = np.full(k, bottom - slack), np.full(k, top + slack)
    wanted = np.arange(1, k + 1)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        enough = above(diagonal, off, middle) >= wanted
        low, high = np.where(enough, middle, low), np.where(enough, high, middle)


class _Shifted:
    """The tridiagonal matrix less a shift, factored with row exchanges."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shift: float, smallest: float):
        n = len(diagonal)
        d, u, u2 = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
        self.steps = []
        for i in range(n - 1):
            e, right = float(off[i]), d[i + 1]
            if abs(d[i]) >= abs(e):
                pivot = d[i] if d[i] != 0 else smallest
                d[i], factor = pivot, e / pivot
                d[i + 1] = right - factor * u[i]
                self.steps.append((False, factor))
            else:
                factor = d[i] / e
                d[i], d[i + 1] = e, u[i] - factor * right
                beyond = u[i + 1]
                u[i], u2[i], u[i + 1] = right, beyond, -factor * beyond
                self.steps.append((True, factor))
        if abs(d[-1]) < smallest:
            d[-1] = smallest
        self.rows = d, u, u2

    def solved(self, right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i, (swapped, factor) in enumerate(self.steps):
            if swapped:
                b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
            else:
                b[i + 1] -= factor * b[i]
        d, u, u2 = self.rows
        n = len(b)
        for i in range(n - 1, -1, -1):
            value = b[i]
            if i + 1 < n:
                value -= u[i] * b[i + 1]
            if i + 2 < n:
                value -= u2[i] * b[i + 2]
            b[i] = value / d[i]
        return np.array(b)


def _vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as rows, by inverse iteration from a fixed random start."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0)) or 1.0
    rng = np.random.default_rng(n)
    found: list[np.ndarray] = []
    start, before = 0, 0.0  # where the cluster begins, and the last shift used in it
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            start = i
        # equal eigenvalues are set apart a little, so that each shift brings up another vector
        shift = float(value) if i == start else min(float(value), before - 10 * EPS * norm)
        before = shift
        factored = _Shifted(diagonal, off, shift, EPS * norm)
        x = rng.standard_normal(n)
        for _ in range(INVERSE_ROUNDS):
            x = factored.solved(x / np.abs(x).max())
            x /= np.abs(x).max()  # a solution can be too large to square
            for _ in range(2):
                for other in found[start:]:
                    x = x - (other @ x) * other
            x /= np.linalg.norm(x)
        found.append(x)
    return np.array(found).reshape(len(values), n)


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    n = len(matrix)
    k = min(k, n)
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(k), np.eye(n)[:k]
    diagonal, off, reflectors = tridiagonalised(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = _vectors(diagonal, off, values)
    for j in range(len(reflectors) - 1, -1, -1):
        v = reflectors[j]
        vectors[:, j + 1 :] -= 2.0 * np.outer(vectors[:, j + 1 :] @ v, v)
    return values * scale, vectors
