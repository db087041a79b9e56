"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

The matrix is a covariance of some hundred dimensions, so this is a step of its
own between two jobs, not the work on the data.  A slice of the spectrum is an
interval whose ends lie in gaps.  The integral of the resolvent along a circle
through both ends projects any vectors onto the slice's eigenvectors; it is
taken by Gauss-Legendre quadrature, one complex shifted solve a point, and
repeated with Rayleigh-Ritz steps until the residuals don't fall any more.
Inertia counts (signs of the pivots of the shifted matrix, in tridiagonal form)
place the slices and say how many eigenvalues each must give.
"""

from __future__ import annotations

import numpy as np

#: points of the quadrature, eigenvalues in a slice, repetitions at most.
POINTS, IN_SLICE, ROUNDS = 16, 8, 60


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar matrix, by reflections."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = x @ x
        if length == 0:
            continue
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x * (2 / length)
        p -= x * (x @ p / length)
        rest -= np.outer(x, p) + np.outer(p, x)
        a[k + 1, k] -= x[0] * 2 * (x @ a[k + 1 :, k]) / length
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: by Sylvester's law as
    many as positive pivots."""
    diagonal, off = form
    least = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for a, b in zip(diagonal.tolist(), [0.0, *off.tolist()], strict=True):
        pivot = a - shift - b * b / pivot
        if pivot == 0:
            pivot = -least
        above += pivot > 0
    return above


def _near(form, k: int, low: float, high: float, width: float) -> float:
    """The k-th largest eigenvalue (k from 1), to ``width``."""
    while high - low > width:
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(form, middle) >= k else (low, middle)
    return (low + high) / 2


def slices(form, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of intervals that hold the ``wanted`` largest
    eigenvalues, and those too near to the last to tell apart."""
    n = len(form[0])
    reach = np.abs(form[0]).max() + 2 * np.abs(np.append(form[1], 0.0)).max()
    at = []
    while len(at) < n:  # until a gap follows the wanted ones
        at.append(_near(form, len(at) + 1, -reach, reach, 1e-10 * reach))
        if len(at) > wanted and at[-2] - at[-1] > 1e-6 * reach:
            break
    every = [at[0] + reach / 4, *at, at[-1] - reach / 4] if len(at) == n else [at[0] + reach / 4, *at]
    gap = lambda k: every[k] - every[k + 1]  # between the k-th and the next
    out, done, count = [], 0, len(every) - 2
    while done < count:
        # the widest gap among the next ends; only real gaps are ends
        ends = [k for k in range(done + 1, count + 1) if gap(k) > 1e-6 * reach]
        near = [k for k in ends if k - done <= IN_SLICE] or ends[:1]
        end = max(near, key=lambda k: (gap(k), k)) if count - done > IN_SLICE else count
        out.append(((every[end] + every[end + 1]) / 2, (every[done] + every[done + 1]) / 2, end - done))
        done = end
    return out


def _project(a: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """The contour integral: ``y`` on the eigenvectors of ``(low, high]``."""
    points, weight = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    for p, w in zip(points, weight, strict=True):
        turn = radius * np.exp(-0.5j * np.pi * (p - 1))  # the upper half; the lower is its mirror
        out += w / 2 * np.real(turn * np.linalg.solve((centre + turn) * np.eye(len(a)) - a, y.astype(complex)))
    return out


def in_slice(a: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """Eigenvectors of the ``count`` eigenvalues in ``(low, high]``."""
    n = len(a)
    y = np.random.default_rng(12).standard_normal((n, min(n, count + count // 2 + 4)))
    norm, best, vectors = np.abs(a).sum(1).max(), np.inf, None
    for _ in range(ROUNDS):
        q = np.linalg.qr(_project(a, y, low, high))[0]
        values, turns = np.linalg.eigh(q.T @ a @ q)
        y = q @ turns
        residuals = np.abs(a @ y - y * values).max(0)
        # mixtures of vectors outside may have Ritz values inside, by chance
        here = np.flatnonzero((values > low) & (values <= high))
        here = np.sort(here[np.argsort(residuals[here], kind="stable")[:count]])
        if len(here) == count:
            residual = residuals[here].max()
            if residual > best / 2 and residual < 1e-9 * norm:
                return vectors
            if residual < best:
                best, vectors = residual, y[:, here]
    if vectors is None or best > 1e-9 * norm:
        raise ArithmeticError(f"the slice ({low}, {high}] did not give its {count} eigenvalues")
    return vectors


def largest(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as
    columns, each with its largest entry positive."""
    a = (a + a.T) / 2
    scale = np.abs(a).max() if a.size else 0.0
    wanted = min(wanted, len(a))
    if not wanted or scale == 0:
        return np.zeros(wanted), np.eye(len(a))[:, :wanted]
    form = tridiagonal(a / scale)
    found = [in_slice(a / scale, low, high, count) for low, high, count in slices(form, wanted)]
    q = np.linalg.qr(np.concatenate(found, axis=1))[0]
    values, turns = np.linalg.eigh(q.T @ (a / scale) @ q)
    vectors = (q @ turns)[:, ::-1][:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values[::-1][:wanted] * scale, vectors * sign
