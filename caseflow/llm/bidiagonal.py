"""Singular values and right singular vectors of one small square matrix, through its bidiagonal form.

Householder reflections bidiagonalise; dqds sweeps find the squared singular values to high relative accuracy; twisted
factorisations of the shifted tridiagonal give the vectors, with a representation of its own for every cluster of values.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
_TOL2 = (100 * EPS) ** 2
#: Values closer than this share of their size get a representation of their own.
_GAP = 1e-3
_DEPTH = 8


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta) with (I - beta v v') x = +-|x| e1."""
    v = x.astype(float).copy()
    rest = float(v[1:] @ v[1:])
    if rest == 0.0:
        return v, 0.0
    v[0] += np.copysign(np.sqrt(v[0] * v[0] + rest), v[0])
    return v, 2.0 / float(v @ v)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right) with matrix = left B right' for upper bidiagonal B."""
    a = matrix.astype(float).copy()
    n = len(a)
    right = np.eye(n)
    for k in range(n):
        v, beta = _reflector(a[k:, k])
        if beta:
            a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
                right[:, k + 1:] -= beta * np.outer(right[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transformation: new q and e, and the d's met on the way (a negative one: the shift is too large)."""
    new_q, new_e, met = [], [], []
    d = q[0] - shift
    for k, own in enumerate(e):
        met.append(d)
        pivot = d + own
        ratio = q[k + 1] / pivot if pivot > 0 else 0.0
        new_q.append(pivot)
        new_e.append(own * ratio)
        d = d * ratio - shift if pivot > 0 else q[k + 1] - shift
    met.append(d)
    new_q.append(d)
    return new_q, new_e, met


def _shifted(q: list[float], e: list[float], shift: float):
    """A sweep with the largest share of ``shift`` that keeps all values non-negative."""
    while shift > 0:
        new_q, new_e, met = _sweep(q, e, shift)
        if min(met) >= 0:
            return new_q, new_e, shift
        shift = 0.5 * shift if shift > 1e-300 else 0.0
    new_q, new_e, _ = _sweep(q, e, 0.0)
    return new_q, new_e, 0.0


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    Every round takes an unshifted sweep, whose d's bound the smallest value from below (1 / sum(1 / d)), and one sweep
    with that bound as shift.
    """
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    todo = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        while q:
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= _TOL2 * (moved + q[-1]) or e[-1] <= _TOL2 * q[-2]:
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((k for k, own in enumerate(e) if own <= _TOL2 * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, met = _sweep(q, e, 0.0)
            bound = 1.0 / sum(1.0 / d for d in met) if min(met) > 1e-290 else 0.0
            q, e, used = _shifted(q, e, bound * (1 - 4 * EPS * len(q)))
            moved += used
    return np.sort(np.maximum(found, 0.0))[::-1] * scale * scale


class Representation:
    """L D L' of a shifted tridiagonal: the pivots d, the couplings d l, and d l l."""

    def __init__(self, d: np.ndarray, coupling: np.ndarray, square: np.ndarray) -> None:
        self.d, self.coupling, self.square = d.tolist(), coupling.tolist(), square.tolist()
        self.n = len(self.d)
        size = max(np.abs(d).max(initial=0.0), np.abs(square).max(initial=0.0))
        self.least = float(size) * EPS * EPS + 1e-300

    def pivots(self, x: float) -> tuple[list[float], list[float]]:
        """Pivots of the factorisation from the top, shifted by x, and the sums on the way."""
        s, sums, out = -x, [], []
        for i in range(self.n):
            sums.append(s)
            pivot = s + self.d[i]
            if abs(pivot) < self.least:
                pivot = -self.least
            out.append(pivot)
            if i < self.n - 1:
                s = self.square[i] / pivot * s - x
        return out, sums

    def below(self, x: float) -> int:
        """How many values are less than x."""
        return sum(p < 0 for p in self.pivots(x)[0])

    def shifted(self, x: float) -> Representation:
        pivots = np.array(self.pivots(x)[0])
        coupling = np.array(self.coupling)
        return Representation(pivots, coupling, coupling ** 2 / pivots[:-1])

    def refined(self, rank: int, low: float, high: float) -> float:
        """The value with ``rank`` values below it, by bisection to full relative accuracy."""
        while self.below(low) > rank:
            low -= max(abs(low), self.least, high - low)
        while self.below(high) <= rank:
            high += max(abs(high), self.least, high - low)
        while high - low > 2 * EPS * max(abs(low), abs(high)) and (middle := 0.5 * (low + high)) not in (low, high):
            if self.below(middle) > rank:
                high = middle
            else:
                low = middle
        return 0.5 * (low + high)

    def vector(self, x: float) -> np.ndarray:
        """Unit vector of the value nearest to x: the two factorisations meet where the twist is smallest."""
        top, sums = self.pivots(x)
        p = self.d[-1] - x
        bottom, ends = [0.0] * self.n, [0.0] * self.n
        ends[-1] = p
        for i in range(self.n - 2, -1, -1):
            pivot = self.square[i] + p
            if abs(pivot) < self.least:
                pivot = -self.least
            bottom[i + 1] = pivot
            p = p / pivot * self.d[i] - x
            ends[i] = p
        twist = int(np.argmin([abs(s + e + x) for s, e in zip(sums, ends)]))
        z = np.zeros(self.n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -self.coupling[i] / top[i] * z[i + 1]
        for i in range(twist, self.n - 1):
            z[i + 1] = -self.coupling[i] / bottom[i + 1] * z[i]
        return z / np.linalg.norm(z)


def _inside(rep: Representation, values: list[float], ranks: list[int], depth: int) -> list[np.ndarray]:
    """Vectors of rising ``values`` of a representation; ``ranks`` are the numbers of values below them."""
    out: list[np.ndarray] = []
    start = 0
    while start < len(values):
        end = start + 1
        while end < len(values) and values[end] - values[end - 1] < _GAP * max(abs(values[end]), abs(values[end - 1])):
            end += 1
        if end == start + 1:
            out.append(rep.vector(values[start]))
        elif depth == _DEPTH:
            out += _settled(rep, values[start:end])
        else:  # move the origin next to the cluster, where its gaps are large against its values
            width = max(values[end - 1] - values[start], abs(values[end - 1]) * EPS)
            origin = values[start] - width
            own = rep.shifted(origin)
            moved = [own.refined(r, v - origin - width, v - origin + width) for v, r in zip(values[start:end], ranks[start:end])]
            out += _inside(own, moved, ranks[start:end], depth + 1)
        start = end
    return out


def _settled(rep: Representation, values: list[float]) -> list[np.ndarray]:
    """Vectors of values that agree to working precision: any orthonormal basis, by inverse iteration."""
    d, coupling, square = np.array(rep.d), np.array(rep.coupling), np.array(rep.square)
    full = np.diag(d + np.concatenate([[0.0], square])) + np.diag(coupling, 1) + np.diag(coupling, -1)
    basis = np.random.default_rng(len(values)).standard_normal((rep.n, len(values)))
    moved = full - (values[0] - rep.least - EPS * np.abs(full).max()) * np.eye(rep.n)
    for _ in range(3):
        basis = np.linalg.qr(np.linalg.solve(moved, basis))[0]
    return list(basis.T)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values of a bidiagonal matrix, falling, and their right vectors as columns."""
    n = len(diagonal)
    peak = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)))
    # a coupling this small leaves every wanted value and vector as they are
    cuts = np.flatnonzero(np.abs(above) <= EPS * EPS * peak)
    found = []
    for start, end in zip([0, *(cuts + 1)], [*(cuts + 1), n]):
        own, next_to = diagonal[start:end], above[start:end - 1]
        found += [(float(value), start, end, rank) for rank, value in enumerate(squared_singular_values(own, next_to)[::-1])]
    found = sorted(found, key=lambda f: (-f[0], f[1], -f[3]))[:most]
    vectors = np.zeros((n, len(found)))
    for start, end in sorted({(f[1], f[2]) for f in found}):
        places = [i for i, f in enumerate(found) if f[1] == start][::-1]
        own, next_to = diagonal[start:end], above[start:end - 1]
        rep = Representation(own ** 2, own[:-1] * next_to, next_to ** 2)
        columns = _inside(rep, [found[i][0] for i in places], [found[i][3] for i in places], 0)
        for place, column in zip(places, columns):
            vectors[start:end, place] = column
    return np.array([f[0] for f in found]), vectors


def singular(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values of a square matrix and its right singular vectors as columns."""
    diagonal, above, right = bidiagonalised(matrix)
    values, vectors = right_vectors(diagonal, above, most)
    return values, right @ vectors
