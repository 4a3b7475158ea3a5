"""Singular values and right singular vectors of a small matrix, by a bidiagonal form.

Householder reflections make the matrix upper bidiagonal; the squares of its entries go through
differential quotient-difference steps with shifts (dqds), whose sums and products lose no
relative accuracy; a twisted factorisation of the shifted form gives each vector.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, v)``: ``matrix`` is U B v.T with U orthogonal, B of diagonal ``a`` and, above it, ``b``."""
    work = np.array(matrix, float)
    n = work.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """Unit ``h`` and ``y`` so that ``x - 2 h (h.x)`` is ``(y, 0, ...)``; ``h`` is 0 if it is so."""
        scale = float(np.abs(x).max(initial=0.0))
        if scale == 0.0 or not x[1:].any():
            return np.zeros_like(x), float(x[0]) if len(x) else 0.0
        h = x / scale
        y = -np.copysign(np.sqrt(h @ h), h[0])
        h[0] -= y
        return h / np.sqrt(h @ h), float(y) * scale

    for k in range(n):
        h, _ = reflector(work[k:, k].copy())
        work[k:, k:] -= 2 * np.outer(h, h @ work[k:, k:])
        if k < n - 2:
            h, _ = reflector(work[k, k + 1:].copy())
            work[k:, k + 1:] -= 2 * np.outer(work[k:, k + 1:] @ h, h)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One step with a shift; None if the shift is above the least value."""
    n = len(q)
    q_new, e_new = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    if d < 0:
        return None
    for i in range(n - 1):
        q_new[i] = d + e[i]
        if q_new[i] == 0.0:  # both are 0: the form splits here
            e_new[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / q_new[i]
            e_new[i] = e[i] * ratio
            d = d * ratio - shift
        if not d >= 0:
            return None
    q_new[n - 1] = d
    return q_new, e_new


def _least_shift(q: np.ndarray, e: np.ndarray) -> float:
    """A guess, mostly a little too small, of the least value: that of the last two rows."""
    if len(q) == 1:
        return float(q[0])
    a, c, b = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], np.sqrt(q[-2] * e[-1])
    half = (a - c) / 2
    root = np.hypot(half, b)
    least = (a + c) / 2 - root if half >= 0 else c - b * b / (abs(half) + root or 1.0)
    return max(0.0, float(min(least, q[-1])) * (1 - 1e-3))


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, by dqds.

    A shift that is too large is divided by four, at last it is zero, which never fails.
    """
    scale = float(max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(a))
    found: list[float] = []
    parts = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        rounds = 0
        while len(q) > 1:
            # an entry that no sum notices splits the form
            small = e <= EPS * EPS * np.minimum(q[:-1] + sigma, q[1:] + sigma)
            cut = np.flatnonzero(small)
            if len(cut):
                at = int(cut[-1]) + 1
                parts.append((q[:at], e[:at - 1], sigma))
                q, e = q[at:], e[at:]
                continue
            if rounds == 0 and q[0] < q[-1]:  # small values belong at the end
                q, e = _reversed(q, e)
            shift = _least_shift(q, e) if rounds else 0.0
            step = _dqds_step(q, e, shift)
            while step is None:
                shift = shift / 4 if shift > EPS * EPS else 0.0
                step = _dqds_step(q, e, shift)
            (q, e), sigma, rounds = step, sigma + shift, rounds + 1
            if rounds > 100 * (len(q) + 10):
                raise RuntimeError("dqds does not converge")
        found.append(float(q[0]) + sigma)
    return np.sort(found)[::-1] * scale * scale


def _reversed(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The form of the matrix with rows and columns in the opposite order, of the same values."""
    return q[::-1].copy(), e[::-1].copy()


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gamma`` of each twist and both factors' multipliers, of B.T B - value."""
    n, tiny = len(a), np.finfo(float).tiny
    big = float(max(np.abs(a).max(), np.abs(b).max(initial=0.0)))
    a = np.where(np.abs(a) < EPS * big, EPS * big, a)  # a change of the matrix's own accuracy
    d, low = a * a, b / a[:-1]
    plus, minus = np.empty(n - 1), np.empty(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i] or tiny
        plus[i] = d[i] * low[i] / pivot
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] * low[i] + p[i + 1] or tiny
        minus[i] = low[i] * d[i] / pivot
        p[i] = p[i + 1] * (d[i] / pivot) - value
    return s + p + value, plus, minus


def _vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B.T B: solves the twisted form from the twist with the least pivot."""
    n = len(a)
    if n == 1:
        return np.ones(1)
    with np.errstate(over="ignore", invalid="ignore"):
        gamma, plus, minus = _twisted(a, b, value)
        twist = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -plus[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -minus[i] * z[i]
    return z / np.sqrt(z @ z)


def right_vectors(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values of a bidiagonal matrix, with unit vectors as columns.

    The matrix is taken apart where an entry above the diagonal vanishes, so equal values have
    vectors in different parts. Vectors of values that nearly meet are made orthogonal, and
    improved by solving again with the same factors.
    """
    n = len(a)
    big = float(max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)))
    cuts = np.flatnonzero(np.abs(b) <= EPS * big / 8) + 1
    bounds = np.r_[0, cuts, n]
    all_: list[tuple[float, int, int]] = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values = squared_singular_values(a[start:end], b[start:end - 1])
        all_ += [(float(v), start, end) for v in values]
    all_.sort(key=lambda x: -x[0])
    values, vectors = [], []
    for value, start, end in all_[:most]:
        z = np.zeros(n)
        z[start:end] = _vector(a[start:end], b[start:end - 1], value)
        near = [w for other, w in zip(values, vectors, strict=True)
                if abs(other - value) <= 1e-6 * max(other, value)]
        z = _apart(a, b, start, end, value, z, near)
        values.append(value)
        vectors.append(z)
    return np.array(values), np.array(vectors).reshape(len(values), n).T


def _apart(a: np.ndarray, b: np.ndarray, start: int, end: int, value: float, z: np.ndarray,
           near: list[np.ndarray]) -> np.ndarray:
    """``z`` without its share in ``near``, by inverse iteration on what is left."""
    if not near:
        return z
    basis = np.array(near)
    rest = z - basis.T @ (basis @ z)
    length = np.sqrt(rest @ rest)
    k = 0
    while length < 0.5 and k < end - start:  # z was one of them: start from another direction
        rest = np.zeros_like(z)
        rest[start + k] = 1.0
        for _ in range(3):
            rest -= basis.T @ (basis @ rest)
            rest[start:end] = _solve(a[start:end], b[start:end - 1], value, rest[start:end])
            rest /= np.sqrt(rest @ rest) or 1.0
        rest -= basis.T @ (basis @ rest)
        length, k = np.sqrt(rest @ rest), k + 1
    return rest / length


def _solve(a: np.ndarray, b: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """Solution x of (B.T B - value) x = right by the stationary factors."""
    n, tiny = len(a), EPS * float(np.max(a * a) or 1.0) * 1e-3
    diagonal = a * a
    diagonal[1:] += b * b
    off = a[:-1] * b
    pivots, x = np.empty(n), right.copy()
    pivots[0] = diagonal[0] - value or tiny
    for i in range(1, n):
        m = off[i - 1] / pivots[i - 1]
        pivots[i] = diagonal[i] - value - m * off[i - 1]
        pivots[i] = pivots[i] if abs(pivots[i]) > tiny else tiny
        x[i] -= m * x[i - 1]
    x[n - 1] /= pivots[n - 1]
    for i in range(n - 2, -1, -1):
        x[i] = (x[i] - off[i] * x[i + 1]) / pivots[i]
    return x
