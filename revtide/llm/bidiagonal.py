"""Singular values and right singular vectors of a small triangular matrix, by qd transforms.

Householder reflections reduce the matrix to a bidiagonal B. Its squared singular values are the eigenvalues of
B'B, whose qd array (squared diagonal, squared superdiagonal) the differential qd algorithm with shifts (dqds)
reduces to them without ever subtracting unlike numbers, so that small ones are as accurate as large ones. For
each of them a twisted factorisation of B'B - value, a top-down and a bottom-up factorisation joined where the
pivot is smallest, gives the vector without iterating.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = 1e-300
#: Relative gap below which neighbouring values count as a cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta with (I - beta v v') x along the first axis."""
    norm = float(np.linalg.norm(x))
    v = x.astype(np.float64).copy()
    if norm == 0:
        return v, 0.0
    v[0] += norm if v[0] >= 0 else -norm
    return v, 2.0 / float(v @ v)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and W of a square matrix = U B W', by Householder reflections from both sides."""
    a = np.array(matrix, np.float64)
    n = len(a)
    w = np.eye(n)
    for k in range(n):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= beta * np.outer(w[:, k + 1:] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), w


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], bool]:
    """One dqds sweep, and whether the shift was small enough, that is if no pivot became negative."""
    up, off, good = [], [], True
    d = q[0] - shift
    for i in range(len(e)):
        good = good and d >= 0
        pivot = d + e[i]
        if pivot > TINY:
            ratio = q[i + 1] / pivot
            up.append(pivot)
            off.append(e[i] * ratio)
            d = d * ratio - shift
        else:
            up.append(max(pivot, 0.0))
            off.append(0.0)
            d = q[i + 1] - shift
    up.append(d)
    return up, off, good and d >= 0


def _pair(q1: float, e1: float, q2: float) -> tuple[float, float]:
    """Both eigenvalues of a qd array of two."""
    half = 0.5 * (q1 + q2 + e1)
    product = q1 * q2
    root = np.hypot(0.5 * (q1 - q2 + e1), np.sqrt(q2 * e1))  # half * half - product would cancel for near values
    large = half + root
    return large, product / large if large > 0 else 0.0


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal, falling."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    work = [(list((diagonal / scale) ** 2), list((above / scale) ** 2), 0.0)]
    while work:
        q, e, base = work.pop()
        small = EPS * EPS
        while q:
            # An entry above the diagonal that no longer matters parts the array, or ends a value at its foot.
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (base + q[i + 1]) + TINY), None)
            if cut is not None and cut < len(e) - 1:
                work.append((q[:cut + 1], e[:cut], base))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if cut is not None or len(q) == 1:
                found.append(base + q.pop())
                e = e[:len(q) - 1]
                continue
            if len(q) == 2:
                found += [base + x for x in _pair(q[0], e[0], q[1])]
                break
            if 1.5 * q[0] < q[-1]:  # dqds finds the smallest first if it stands last
                q, e = q[::-1], e[::-1]
            shift = _pair(q[-2], e[-1], q[-1])[1]
            for _ in range(4):
                after = _transform(q, e, shift)
                if after[2]:
                    break
                shift *= 0.5
            else:
                shift = 0.0
                after = _transform(q, e, shift)
            q, e = after[0], after[1]
            base += shift
    return np.sort(np.array(found))[::-1] * scale * scale


class Twisted:
    """Twisted factorisations of B'B - value for a bidiagonal B without zeros."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray):
        least = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0)) * EPS * EPS
        a = np.where(np.abs(diagonal) < least, least, diagonal)
        self.square = (a * a).tolist()
        self.lower = (above / a[:-1]).tolist()
        self.n = len(a)

    def vector(self, value: float) -> np.ndarray:
        """Unit vector of an eigenvalue."""
        n, square, lower = self.n, self.square, self.lower
        down, s = [], [-value]
        for i in range(n - 1):
            pivot = s[i] + square[i]
            pivot = pivot if abs(pivot) > TINY else TINY
            step = square[i] * lower[i] / pivot
            down.append(step)
            s.append(step * lower[i] * s[i] - value)
        up, p = [0.0] * (n - 1), [0.0] * n
        p[-1] = square[-1] - value
        for i in range(n - 2, -1, -1):
            pivot = square[i] * lower[i] * lower[i] + p[i + 1]
            pivot = pivot if abs(pivot) > TINY else TINY
            ratio = square[i] / pivot
            up[i] = lower[i] * ratio
            p[i] = p[i + 1] * ratio - value
        twist = min(range(n), key=lambda i: abs(s[i] + p[i] + value))
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -up[i] * z[i]
        return z / np.linalg.norm(z)

    def product(self, z: np.ndarray) -> np.ndarray:
        """B'B z."""
        a, above = np.sqrt(self.square), np.array(self.lower) * np.sqrt(self.square[:-1])
        y = a * z
        y[:-1] += above * z[1:]
        out = a * y
        out[1:] += above * y[:-1]
        return out

    def improved(self, value: float, start: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Inverse iteration orthogonal to other vectors, for a vector of a cluster that they share.

        Elimination chooses its pivots here, as a factorisation without that can grow within a cluster.
        """
        shifted = np.column_stack([self.product(row) for row in np.eye(self.n)])
        shifted -= np.eye(self.n) * (value + 2 * EPS * max(self.square))
        z = start
        for _ in range(4):
            z = np.linalg.solve(shifted, orthogonal(z, others))
            z /= np.linalg.norm(z)
        return orthogonal(z, others)


def orthogonal(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    """A vector made orthogonal to the rows of ``others`` and of unit length."""
    for _ in range(2):
        z = z - (others @ z) @ others
    return z / np.linalg.norm(z)


def right_vectors(
    diagonal: np.ndarray, above: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Right singular vectors (rows) of a bidiagonal for its largest squared singular values, which fall.

    Where the superdiagonal is nothing, the bidiagonal falls into parts; a value's vector then lies in the part
    it belongs to.
    """
    n, limit = len(diagonal), EPS * max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    ends = [*(np.flatnonzero(np.abs(above) <= limit) + 1).tolist(), n]
    parts = []
    for start, end in zip([0, *ends], ends):
        own = squared_singular_values(diagonal[start:end], above[start:end - 1])
        parts += [(value, start, end) for value in own]
    parts.sort(key=lambda x: -x[0])
    factors: dict[int, Twisted] = {}
    random = np.random.default_rng(1)
    out = np.zeros((len(values), n))
    for k in range(len(values)):
        value, start, end = parts[k]
        factor = factors.setdefault(start, Twisted(diagonal[start:end], above[start:end - 1]))
        near = [
            j for j in range(k) if parts[j][1] == start and parts[j][0] - value <= CLUSTER * parts[j][0]
        ]
        z = factor.vector(value)
        others = out[near, start:end]
        rest = z - (others @ z) @ others
        wrong = np.linalg.norm(factor.product(z) - value * z) > 64 * EPS * parts[0][0]
        if wrong or np.linalg.norm(rest) < 0.5:
            rest = factor.improved(value, random.normal(size=end - start), others)
        out[k, start:end] = rest
        out[k] = orthogonal(out[k], out[:k])
    return out


def right_singular(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values of a square matrix, falling, and their vectors as rows.

    Values that rounding cannot tell from zero, and their vectors, are left out. A vector's largest entry
    is positive.
    """
    diagonal, above, w = bidiagonalised(matrix)
    values = squared_singular_values(diagonal, above)
    if not len(values) or values[0] <= 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    values = values[values > values[0] * (len(matrix) * EPS) ** 2][:count]
    vectors = right_vectors(diagonal, above, values) @ w.T
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    largest = np.abs(vectors).argmax(axis=1)
    return values, vectors * np.sign(vectors[np.arange(len(values)), largest])[:, None]
