"""Symmetric eigenproblems grown by rank-one updates.

``(values, vectors)`` of a positive semidefinite matrix A become those of A + rho v v' without forming either matrix: in the basis of the vectors
the new eigenvalues are the roots of the secular equation 1 + rho sum z_j^2 / (d_j - x) = 0, one between each two old ones. Coordinates
that the update hardly touches, and all but one of equal eigenvalues after a reflection, are deflated: they stay as they are. The vectors are
taken from the z that has the computed roots as its exact ones, which keeps them orthogonal however close the roots lie.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_STEPS = 100  # bisection alone would need about 60


def _secular(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_j / (d_j - x), d strictly rising: the index of the pole each root is measured from, and the distance."""
    k = len(d)
    if k == 1:
        return np.zeros(1, int), z2.copy()
    right = np.append(d[1:], d[-1] + z2.sum())
    half = (right - d) / 2
    index = np.arange(k)
    at_half = 1 + (z2 / ((d - d[:, None]) - half[:, None])).sum(1)
    near_right = (at_half < 0) & (index < k - 1)
    origin = np.where(near_right, index + 1, index)
    apart = d - d[origin][:, None]  # poles as seen from each root's origin
    low, high = np.where(near_right, -half, 0.0), np.where(near_right, 0.0, np.where(at_half < 0, right - d, half))
    low[-1], high[-1] = (half[-1], right[-1] - d[-1]) if at_half[-1] < 0 else (0.0, half[-1])
    x = (low + high) / 2
    before = np.minimum(index, k - 2)  # the two poles that the interpolation goes by
    left_side = np.arange(k) <= before[:, None]
    open_ = np.ones(k, bool)
    for _ in range(_STEPS):
        gap = apart - x[:, None]
        with np.errstate(all="ignore"):
            term = z2 / gap
            slope = term / gap
            psi, dpsi = np.where(left_side, term, 0).sum(1), np.where(left_side, slope, 0).sum(1)
            whole, dwhole = term.sum(1), slope.sum(1)
            f, size = 1 + whole, 1 + np.abs(psi) + np.abs(whole - psi)
            open_ &= (np.abs(f) > _EPS * k * size) & (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
            if not open_.any():
                break
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            a0, a1 = gap[index, before], gap[index, before + 1]
            a = (a0 + a1) * f - a0 * a1 * dwhole
            b = a0 * a1 * f
            c = f - a0 * dpsi - a1 * (dwhole - dpsi)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = (a[-1] + root[-1]) / (2 * c[-1]) if a[-1] >= 0 else 2 * b[-1] / (a[-1] - root[-1])
            new = x + step
            inside = (new > low) & (new < high)
        x = np.where(open_, np.where(inside, new, (low + high) / 2), x)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors (columns) after adding rho v v', rho not negative."""
    z = vectors.T @ v
    norm = float(np.sqrt(z @ z))
    r = rho * norm * norm
    if not r > 0:
        return values, vectors
    z /= norm
    tolerance = 8 * _EPS * max(float(values[-1]), r)
    active = np.flatnonzero(r * np.abs(z) > tolerance)
    if not len(active):  # lost in rounding
        return values, vectors
    d = values[active]
    equal = np.diff(d) <= tolerance
    if equal.any():
        vectors, kept = vectors.copy(), np.ones(len(active), bool)
        start = 0
        while start < len(active):
            end = start + 1
            while end < len(active) and d[end] - d[start] <= tolerance:
                end += 1
            if end - start > 1:  # reflect the part of z in this eigenspace onto its last axis
                own = active[start:end]
                part = z[own]
                length = np.sqrt(part @ part)
                mirror = part.copy()
                mirror[-1] += np.copysign(length, part[-1])
                mirror /= np.sqrt(mirror @ mirror)
                vectors[:, own] -= 2 * np.outer(vectors[:, own] @ mirror, mirror)
                z[own] = 0
                z[own[-1]] = -np.copysign(length, part[-1])
                kept[start:end - 1] = False
            start = end
        active = active[kept]
        d = values[active]
    za = z[active]
    origin, x = _secular(d, r * za * za)
    gap = (d - d[origin][:, None]) - x[:, None]  # d_j - root_i
    k = len(d)
    over = d[None, :] - d[:, None]
    below = np.zeros((k, k))
    below[:-1] = np.where(np.arange(k) <= np.arange(k - 1)[:, None], -over[:, 1:].T, -over[:, :-1].T)
    below[-1] = -1
    exact = np.sqrt(np.abs(np.prod(gap / below, axis=0)))  # the z for which the roots are exact, but for a factor
    turn = np.copysign(exact, za) / gap
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    grown, turned = values.copy(), vectors.copy()
    grown[active] = d[origin] + x
    turned[:, active] = vectors[:, active] @ turn.T
    order = np.argsort(grown, kind="stable")
    return grown[order], turned[:, order]


class Spectrum:
    """Eigen-decomposition of the scatter of rows about their mean, grown row by row."""

    def __init__(self, size: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(size), np.zeros(size), np.eye(size)

    def add(self, row: np.ndarray) -> None:
        off = row - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), off)
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        """Takes in another spectrum: its axes one by one, then the shift between the means."""
        if not other.n:
            return
        n = self.n + other.n
        off = other.mean - self.mean
        for value, axis in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), axis)
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, off)
        self.mean, self.n = self.mean + off * (other.n / n), n
