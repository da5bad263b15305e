"""Eigendecompositions of scatter matrices that grow by rank-one updates."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

EPS = np.finfo(np.float64).eps


class Spectrum(NamedTuple):
    """n vectors: their mean, and the eigenvalues (ascending) and eigenvectors (columns) of their centred scatter."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    def to_bytes(self) -> bytes:
        return np.concatenate([self.mean, self.values, self.vectors.ravel()]).tobytes()

    @staticmethod
    def from_bytes(n: int, length: int, data: bytes) -> Spectrum:
        all_ = np.frombuffer(data, dtype=np.float64)
        return Spectrum(n, all_[:length].copy(), all_[length : 2 * length].copy(), all_[2 * length :].reshape(length, length).copy())


def empty_spectrum(length: int) -> Spectrum:
    return Spectrum(0, np.zeros(length), np.zeros(length), np.eye(length))


def secular_roots(poles: np.ndarray, squares: np.ndarray, rho: float) -> np.ndarray:
    """The matrix poles[j] - root[i] of the roots of 1 + rho * sum(squares / (poles - x)) = 0.

    `poles` ascend and differ, `squares` are positive with sum 1, rho is positive: one root lies
    above each pole, the last one at most rho above the last pole. Each root is found as a
    distance from the pole nearer to it, so the small differences keep their digits. Steps solve
    the equation of the two poles beside the root ("middle way"); a step that leaves the bracket
    halves it.
    """
    count = len(poles)
    if count == 1:
        return np.array([[-rho]])
    rows = np.arange(count)
    ends = np.append(poles[1:], poles[-1] + rho)
    half = (ends - poles) / 2
    below = poles[None, :] - (poles + half)[:, None]
    at_middle = 1 / rho + (squares / below).sum(axis=1)
    upper = (at_middle < 0) & (rows < count - 1)
    origin = np.where(upper, ends, poles)
    low = np.where(upper, -half, 0.0)
    high = np.where(upper, 0.0, half)
    last = count - 1
    if at_middle[last] < 0:
        low[last], high[last] = half[last], 2 * half[last]
    apart = poles[None, :] - origin[:, None]
    left = np.minimum(rows, count - 2)
    right = left + 1
    to_left, to_right = apart[rows, left], apart[rows, right]
    before = np.tri(count, count, 0, dtype=bool)
    before[last, last] = False
    x = (low + high) / 2
    for step in range(100):
        gap = apart - x[:, None]
        part = squares / gap
        f = 1 / rho + part.sum(axis=1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        bound = 1 / rho + np.abs(part).sum(axis=1)
        done = (np.abs(f) <= 4 * EPS * bound) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        slope = part / gap
        slope_left = np.where(before, slope, 0.0).sum(axis=1)
        slope_right = slope.sum(axis=1) - slope_left
        d_left, d_right = to_left - x, to_right - x
        with np.errstate(all="ignore"):
            c = f - d_left * slope_left - d_right * slope_right
            a = (d_left + d_right) * f - d_left * d_right * (slope_left + slope_right)
            b = d_left * d_right * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            inner = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            outer = np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root))
            new = x + np.where(rows == last, outer, inner)
        fine = np.isfinite(new) & (new > low) & (new < high) & (step < 30)
        x = np.where(done, x, np.where(fine, new, (low + high) / 2))
    return apart - x[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, along: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of vectors diag(values) vectors^T + weight * along along^T, for weight >= 0.

    Components of the update too small to matter and pairs of equal eigenvalues are deflated: a
    rotation moves the whole update of a pair to one of the two. The others solve the secular
    equation. Their eigenvectors belong to the update for which the found roots are exact, so
    they are orthogonal however close roots lie.
    """
    z = vectors.T @ along
    norm = float(np.sqrt(z @ z))
    rho = weight * norm * norm
    if not rho > 0:
        return values, vectors
    z = z / norm
    tolerance = 8 * EPS * max(float(values[-1]), rho)
    active = np.flatnonzero(rho * np.abs(z) > tolerance)
    if len(active) > 1:
        d, w = values[active], z[active]
        together = np.hypot(w[1:], w[:-1])
        if (np.abs(np.diff(d) * w[1:] * w[:-1]) <= tolerance * together * together).any():
            values, vectors, z = values.copy(), vectors.copy(), z.copy()
            kept = [active[0]]
            for j in active[1:].tolist():
                i = kept[-1]
                r = float(np.hypot(z[i], z[j]))
                c, s = float(z[j]) / r, float(z[i]) / r
                if abs((values[j] - values[i]) * c * s) <= tolerance:
                    turned = c * vectors[:, i] - s * vectors[:, j]
                    vectors[:, j] = s * vectors[:, i] + c * vectors[:, j]
                    vectors[:, i] = turned
                    between = values[j] - values[i]
                    values[i], values[j] = values[i] + between * s * s, values[j] - between * s * s
                    z[i], z[j] = 0.0, r
                    kept.pop()
                kept.append(j)
            active = np.array(kept)
            active = active[np.argsort(values[active], kind="stable")]
    if not len(active):
        return values, vectors
    d, w = values[active], z[active]
    count = len(active)
    size = float(w @ w)
    rho *= size
    gap = secular_roots(d, w * w / size, rho)
    if count > 1:
        # Of the pairs (root i, pole j) the poles beside each other divide, so no product overflows.
        between = d[:, None] - d[None, :]
        under = np.empty((count, count))
        lower = np.tri(count, count, -1, dtype=bool).T
        under[lower] = between[lower]
        shifted = np.vstack([between[1:], np.full(count, rho)])
        under[~lower] = shifted[~lower]
        fitted = np.sqrt(np.abs(np.prod(-gap / under, axis=0)))
    else:
        fitted = np.ones(1)
    turn = (np.copysign(fitted, w)[None, :] / gap).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    new_values = np.where(np.abs(np.diagonal(gap)) <= np.abs(np.append(np.diagonal(gap, 1), np.inf)), d - np.diagonal(gap), np.append(d[1:], 0) - np.append(np.diagonal(gap, 1), 0))
    values, vectors = values.copy(), vectors.copy()
    values[active] = new_values
    vectors[:, active] = vectors[:, active] @ turn
    order = np.argsort(values, kind="stable")
    if (order[1:] > order[:-1]).all():
        return values, vectors
    return values[order], vectors[:, order]


def add_vector(spectrum: Spectrum, vector: np.ndarray) -> Spectrum:
    """One more vector: the scatter about the new mean grows by one centred square."""
    apart = vector - spectrum.mean
    n = spectrum.n + 1
    values, vectors = rank_one(spectrum.values, spectrum.vectors, apart, spectrum.n / n)
    return Spectrum(n, spectrum.mean + apart / n, values, vectors)


def combine(one: Spectrum, other: Spectrum) -> Spectrum:
    """The vectors of both: the other's spectrum is added eigenvector by eigenvector, then the two means' distance."""
    if not one.n or not other.n:
        return one if one.n else other
    values, vectors = one.values, one.vectors
    for k in range(len(other.values)):
        if other.values[k] > 0:
            values, vectors = rank_one(values, vectors, other.vectors[:, k], float(other.values[k]))
    apart, n = other.mean - one.mean, one.n + other.n
    values, vectors = rank_one(values, vectors, apart, one.n / n * other.n)
    return Spectrum(n, one.mean + apart * (other.n / n), values, vectors)
