"""Eigendecompositions kept up to date under rank-one updates.

``U diag(d) U'  +  v v'`` has the eigenvalues of ``diag(d) + z z'`` with
``z = U' v``. Entries of z that are as good as zero, and all but one of those
that share an eigenvalue, are deflated: their pairs stay. The others interlace
as the roots of the secular equation ``1 + sum z_i^2 / (d_i - x) = 0``. The
roots are held as distances from the nearer pole, so that differences keep
their digits, and z is recomputed from them, so that the new vectors are
orthogonal to working precision.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
ROUNDS = 80
#: Updates after which the vectors are made orthogonal anew.
POLISH = 512


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots and the differences pole minus root, poles in rows.

    ``d`` rises strictly and all ``z2`` are positive. Root j lies between pole j
    and the next one; the last lies within the sum of ``z2`` above the last pole.
    """
    k = len(d)
    if k == 1:
        return d + z2, -z2[None, :]
    column = np.arange(k)
    ends = np.append(d[1:], d[-1] + z2.sum())
    width = ends - d
    below = np.tri(k, dtype=bool).T  # poles up to j
    gap = d[:, None] - d[None, :]
    middle = 1 + (z2[:, None] / (gap - width / 2)).sum(0)
    right = (middle < 0) & (column < k - 1)
    origin = np.where(right, ends, d)
    base = d[:, None] - origin[None, :]
    base[column[right] + 1, column[right]] = 0.0
    base[column[~right], column[~right]] = 0.0
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, np.where(middle < 0, width, width / 2))
    low = np.where((column == k - 1) & (middle < 0), width / 2, low)
    shift = np.where(right, high / 2 + low / 2, low / 2 + high / 2)
    upper = np.where(right, 0.0, width)  # the next pole, seen from the origin
    lower = np.where(right, -width, 0.0)
    for _ in range(ROUNDS):
        delta = base - shift
        term = z2[:, None] / delta
        slope = term / delta
        f = 1 + term.sum(0)
        done = np.abs(f) <= 4 * EPS * k * (1 + np.abs(term).sum(0))
        low, high = np.where(f < 0, shift, low), np.where(f < 0, high, shift)
        done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        left_slope = np.where(below, slope, 0.0).sum(0)
        all_slope = slope.sum(0)
        one, two = lower - shift, upper - shift
        # a rational function with both neighbouring poles, fitted to value and slopes of both sides
        c = f - one * left_slope - two * (all_slope - left_slope)
        a, b = (one + two) * f - one * two * all_slope, one * two * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        new = shift + step
        inside = (new > low) & (new < high)
        shift = np.where(done, shift, np.where(inside, new, low / 2 + high / 2))
    return origin + shift, base - shift


def updated(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors (columns) after adding ``v v'``."""
    z = vectors.T @ v
    size = float(z @ z)
    if size == 0.0:
        return values, vectors
    scale = max(float(np.abs(values).max()), size)
    small = 8 * EPS * scale
    keep = np.abs(z) * np.sqrt(size) > small
    index = np.flatnonzero(keep)
    if not len(index):
        return values, vectors
    vectors, copied = vectors, False
    if len(index) > 1:
        zi = z[index]
        close = np.diff(values[index]) * np.abs(zi[1:] * zi[:-1]) <= small * (zi[1:] ** 2 + zi[:-1] ** 2)
        if close.any():
            vectors, values, z, copied = vectors.copy(), values.copy(), z.copy(), True
            last = index[0]
            for i in index[1:]:
                r = np.hypot(z[last], z[i])
                c, s = z[i] / r, z[last] / r
                if (values[i] - values[last]) * abs(c * s) <= small:
                    # turn the two vectors so that the earlier one no longer meets v
                    one, two = vectors[:, last].copy(), vectors[:, i].copy()
                    vectors[:, last], vectors[:, i] = c * one - s * two, s * one + c * two
                    values[last], values[i] = c * c * values[last] + s * s * values[i], s * s * values[last] + c * c * values[i]
                    z[last], z[i] = 0.0, r
                    keep[last] = False
                last = i
            index = np.flatnonzero(keep)
    d, zi = values[index], z[index]
    if (np.diff(d) <= 0).any():
        rising = np.argsort(d, kind="stable")
        index, d, zi = index[rising], d[rising], zi[rising]
        if (np.diff(d) <= 0).any():
            d = np.maximum.accumulate(d)
            d = d + np.arange(len(d)) * EPS * scale
    new, delta = _roots(d, zi * zi)
    k = len(d)
    # z anew from the roots: what makes them the exact eigenvalues
    ratio = -delta.T / np.where(np.eye(k, dtype=bool), 1.0, d[:, None] - d[None, :]).T  # row: root, column: pole
    ratio[np.arange(k), np.arange(k)] = -np.diag(delta)
    exact = np.sqrt(np.abs(ratio.prod(axis=0))) * np.sign(zi)
    turn = exact[:, None] / delta
    turn /= np.sqrt((turn * turn).sum(0))
    if not copied:
        values, vectors = values.copy(), vectors.copy()
    vectors[:, index] = vectors[:, index] @ turn
    values[index] = new
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Scatter:
    """Count, mean and eigendecomposition of the scatter matrix of the rows seen so far."""

    def __init__(self, dimensions: int):
        self.count, self.mean = 0, np.zeros(dimensions)
        self.values, self.vectors = np.zeros(dimensions), np.eye(dimensions)
        self.updates = 0

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = updated(self.values, self.vectors, v)
        self.updates += 1
        if self.updates % POLISH == 0:
            q, r = np.linalg.qr(self.vectors)
            self.vectors = q * np.sign(np.diag(r))

    def add(self, row: np.ndarray) -> None:
        """One more row: the scatter grows by the centred row, weighted."""
        step = row - self.mean
        self.count += 1
        if self.count > 1:
            self._update(step * np.sqrt((self.count - 1) / self.count))
        self.mean = self.mean + step / self.count

    def merge(self, count: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        """Another part's rows: its spectrum pair by pair, then the difference of the means."""
        if not count:
            return
        if not self.count:
            self.count, self.mean, self.values, self.vectors = count, mean, values, vectors
            return
        for value, vector in zip(values, vectors.T):
            if value > 0:
                self._update(vector * np.sqrt(value))
        step, total = mean - self.mean, self.count + count
        self._update(step * np.sqrt(self.count * (count / total)))
        self.mean, self.count = self.mean + step * (count / total), total
