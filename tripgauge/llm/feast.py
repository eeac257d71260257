"""Leading eigenpairs of a symmetric matrix by FEAST contour integration, with inertia counts as proof that none is missed.

``intervals`` cuts the wanted part of the spectrum at gaps, located by
inertia counts. ``solve`` finds all eigenpairs of one interval: quadrature of
complex shifted solves along a circle around it projects a block of vectors
onto the interval's eigenspace, Rayleigh-Ritz extracts the pairs, and the
projection is repeated until the residuals vanish. Intervals don't depend on
each other. A matrix is as large as the vectors' dimension, not the corpus.
"""

from __future__ import annotations

import numpy as np


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        part = a[k + 1:, k:]
        part -= 2 * np.outer(x, x @ part)
        part = a[k:, k + 1:]
        part -= 2 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """Counts eigenvalues above a shift: the positive pivots of the factorisation of the shifted matrix (Sylvester's law),
    taken on its tridiagonal form, where the recurrence is backward stable."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, off = tridiagonal(matrix)
        self.squares = np.concatenate([[0.0], off * off])
        self.scale = float(np.abs(self.diagonal).max(initial=0) + 2 * np.sqrt(self.squares.max(initial=0)))
        self.tiny = np.finfo(float).tiny + self.scale * np.finfo(float).eps ** 2

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for a, b in zip(self.diagonal.tolist(), self.squares.tolist()):
            pivot = a - shift - b / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            count += pivot > 0
        return count

    def value(self, k: int, rel: float = 1e-12) -> float:
        """The k-th largest eigenvalue (k from 1) by bisection."""
        low, high = -self.scale, self.scale
        while high - low > rel * self.scale:
            middle = (low + high) / 2
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle
            if middle in (low, high) and (low + high) / 2 in (low, high):
                break
        return (low + high) / 2


def intervals(matrix: np.ndarray, most: int, chunk: int = 8) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top down: disjoint intervals that hold the ``most`` largest eigenvalues, and those that
    can't be told from the last of them. Cuts lie in the widest gap after each ``chunk`` to 2 * ``chunk`` values."""
    inertia, d = Inertia(matrix), len(matrix)
    want = min(most, d)
    values = [inertia.value(k) for k in range(1, min(d, want + 2 * chunk) + 1)]
    span = max(inertia.scale, np.finfo(float).tiny)
    bottom = min(values) - 0.01 * span if len(values) == d else None  # nothing lies below
    out, high, done = [], values[0] + 0.01 * span, 0
    while done < want:
        # Gaps after value number k (from 1); the last cut must not come before number ``want``.
        least = min(done + chunk, want)
        choices = [(values[k - 1] - values[k], k) for k in range(least, min(done + 2 * chunk, len(values) - 1) + 1) if k < len(values)]
        if bottom is not None and len(values) <= done + 2 * chunk:
            choices.append((values[-1] - bottom, len(values)))
        gap, k = max(choices, default=(0.0, least))
        if gap <= 1e-9 * span:  # one long cluster: go on to where it ends, or to the end of the values known
            k = next((j for j in range(least, len(values)) if values[j - 1] - values[j] > 1e-9 * span), len(values))
        low = (values[k - 1] + values[k]) / 2 if k < len(values) else bottom if bottom is not None else values[-1] - 1e-6 * span
        out.append((low, high, inertia.above(low) - inertia.above(high)))
        done, high = inertia.above(low), low
    return out


def solve(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = 16, turns: int = 30, tolerance: float = 4e-15) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenvalues (falling) between low and high and their unit eigenvectors (columns)."""
    d = len(matrix)
    if not count:
        return np.empty(0), np.empty((d, 0))
    width = min(d, count + max(6, count // 2))
    basis = np.random.default_rng(0).standard_normal((d, width))
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    scale = np.abs(matrix).max() * d
    best = None
    for _ in range(turns):
        # Half the circle is enough: the matrix is real, so the other half adds the complex conjugate.
        projected = np.zeros_like(basis)
        for point, weight in zip(points, weights):
            turn = np.exp(0.5j * np.pi * (1 + point))
            solved = np.linalg.solve((centre + radius * turn) * np.eye(d) - matrix, basis)
            projected += 0.5 * weight * (radius * turn * solved).real
        # Rayleigh-Ritz on an orthonormal basis of the projected block.
        q, size, _ = np.linalg.svd(projected, full_matrices=False)
        q = q[:, size > size[0] * 1e-14]
        small = q.T @ matrix @ q
        values, inner = np.linalg.eigh((small + small.T) / 2)
        vectors = q @ inner
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) >= count:
            # A mixture of outer vectors may have a Ritz value inside, but never a small residual; the inertia count says how many are real.
            misses = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(axis=0)
            real = np.argsort(misses, kind="stable")[:count]
            residual, inside = misses[real[-1]], inside[real]
            order = inside[np.argsort(-values[inside])]
            if best is None or residual < 0.5 * best[0]:
                best = (residual, values[order], vectors[:, order])
                if residual <= tolerance * scale:
                    break
            else:  # no longer gets better
                break
        basis = vectors if vectors.shape[1] == width else np.hstack([vectors, np.random.default_rng(1).standard_normal((d, width - vectors.shape[1]))])
    if best is None or best[0] > 1e-10 * scale:
        raise ArithmeticError(f"the interval ({low}, {high}] holds {count} eigenvalues by inertia; the contour found others")
    return best[1], best[2]
