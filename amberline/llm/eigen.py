"""Eigenvectors of a symmetric matrix: a float32 decomposition, refined by matrix products in higher precision.

One step of Ogita and Aishima takes approximate eigenvectors X of A, forms R = I - X'X and S = X'AX, and adds X E, where E follows from R
and S entry by entry; errors are squared in each step.  Eigenvalues closer together than the errors cannot be told apart by that: their vectors span the right
space but are mixed.  For each such cluster the small matrix of A on its space is solved by itself, after a shift by the cluster's
middle, which shows its gaps in full relative precision; the next step works with these vectors.
"""

from __future__ import annotations

import numpy as np

#: What is summed up in: 64-bit mantissas where the machine has them.
HIGH = np.longdouble
STEPS, SLICES = 30, 4


def _slices(a: np.ndarray, axis: int) -> list[np.ndarray]:
    """float64 matrices that add up to ``a``, each with so few bits that sums of their products along ``axis`` are exact."""
    bits = (53 - int(a.shape[axis] - 1).bit_length()) // 2
    out = []
    for _ in range(SLICES):
        top = np.abs(a).max(axis=axis, keepdims=True)
        unit = np.ldexp(HIGH(1), np.frexp(np.where(top > 0, top, 1))[1] - bits)
        part = np.rint(a / unit) * unit
        out.append(part.astype(np.float64))
        a = a - part
        if not a.any():
            break
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in higher precision, as exact float64 products of slices; those that lie below the last bits are left out."""
    out = np.zeros((a.shape[0], b.shape[1]), dtype=HIGH)
    right = _slices(b, 0)
    for i, x in enumerate(_slices(a, 1)):
        for y in right[:SLICES - i]:
            out += x @ y
    return out


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(corrected vectors, eigenvalues, which are in order of the vectors, size of the correction, gap below which values are a cluster)."""
    r = np.eye(len(a), dtype=HIGH) - product(x.T, x)
    s = product(x.T, product(a, x))
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diagonal(s) / (1 - np.diagonal(r))
    off = s - np.diag(values)
    # Frobenius norms bound the spectral ones
    gap = 2 * float(np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum()))
    apart = values[None, :] - values[:, None]
    clear = np.abs(apart) > gap
    np.fill_diagonal(clear, False)
    e = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
    return x + product(x, e), values, e, gap


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of values that neighbours link by steps of at most ``gap``; groups of one are left out."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray, middle) -> np.ndarray:
    """The vectors of one cluster, turned inside their space."""
    q, _ = np.linalg.qr(x.astype(np.float64))
    q = q.astype(HIGH)
    q = q + product(q, np.eye(q.shape[1], dtype=HIGH) - product(q.T, q)) / 2  # orthogonal in the higher precision too
    small = product(q.T, product(a, q) - middle * q)
    scale = np.abs(small).max()
    if not scale:
        return q
    small = (small + small.T) / (2 * scale)
    _, turn = np.linalg.eigh(small.astype(np.float64))
    return product(q, turn.astype(HIGH))


def refined_eigenvectors(a: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, to double precision.

    ``start`` are approximate eigenvectors, by default those of the matrix in float32.  Vectors of eigenvalues that are
    equal to double precision are some orthonormal basis of their space.  A vector's largest entry by amount is positive.  A zero matrix has
    the unit vectors.
    """
    a = np.asarray(a, dtype=np.float64)
    n = len(a)
    scale = float(np.abs(a).max()) if n else 0.0
    if not scale:
        return np.zeros(n), np.eye(n)
    high = ((a + a.T) / 2).astype(HIGH) / HIGH(scale)
    if start is None:
        _, start = np.linalg.eigh(high.astype(np.float32))
    x = start.astype(HIGH)
    last, shape = np.inf, None
    for _ in range(STEPS):
        x, values, e, gap = _step(high, x)
        size, groups, before = float(np.abs(e).max()), clusters(values, gap), shape
        shape = sorted(len(g) for g in groups)
        if shape == before and (size <= np.finfo(np.float64).eps / 8 or size >= last / 2):
            break  # nothing is left that the precision could still correct
        for g in groups:
            x[:, g] = _solve_cluster(high, x[:, g], values[g].sum() / len(g))
        last = size
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((x * product(high, x)).sum(axis=0) * HIGH(scale)).astype(np.float64)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    top = np.abs(x).argmax(axis=0)
    return values[order], x * np.where(x[top, np.arange(n)] < 0, -1.0, 1.0)
