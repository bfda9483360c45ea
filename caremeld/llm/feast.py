"""The largest eigenvalues of a symmetric matrix and their vectors by contour integration.

Intervals that hold a few eigenvalues each are found by counting: the signs of the pivots of a shifted matrix tell how many
eigenvalues lie below the shift (Sylvester's law of inertia; the matrix is made tridiagonal once, so that a count is
linear). For every interval the projector onto its eigenvectors, an integral of the resolvent over a circle around the
interval, is taken by quadrature: complex shifted solves, applied to a block of vectors. Rayleigh and Ritz's method
takes eigenpairs out of the projected block, which is projected anew until the pairs are exact and as many as counted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Contour:
    """``nodes``: quadrature points of a half circle; ``most``: eigenvalues of an interval, but for clusters that can't be
    split; ``tolerance``: residual of an eigenpair against the matrix, before the last round; ``rounds`` before the block is
    doubled."""

    nodes: int = 8
    most: int = 4
    tolerance: float = 1e-13
    rounds: int = 8


class Inertia:
    """Counts eigenvalues of one symmetric matrix above shifts."""

    def __init__(self, matrix: np.ndarray):
        a = matrix.copy()
        n = len(a)
        for k in range(n - 2):
            reflector = a[k + 1 :, k].copy()
            size = np.linalg.norm(reflector)
            if not np.any(reflector[1:]):
                continue
            end = -np.copysign(size, reflector[0])
            reflector[0] -= end
            reflector /= np.linalg.norm(reflector)
            rest = a[k + 1 :, k + 1 :]
            image = rest @ reflector
            image -= (reflector @ image) * reflector
            rest -= 2 * (np.outer(reflector, image) + np.outer(image, reflector))
            a[k + 1, k] = end
        self.diagonal = np.diag(a).tolist()
        self.squares = [0.0, *(np.diag(a, -1) ** 2).tolist()]
        self.bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))

    def above(self, shift: float) -> int:
        """How many eigenvalues exceed ``shift``."""
        pivot, positive = 1.0, 0
        least = np.finfo(float).eps * max(self.bound, 1e-300)
        for diagonal, square in zip(self.diagonal, self.squares):
            pivot = diagonal - shift - square / pivot
            if abs(pivot) < least:
                pivot = -least
            positive += pivot > 0
        return positive


def intervals(inertia: Inertia, wanted: int, contour: Contour) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the highest, until they hold the ``wanted`` largest positive eigenvalues."""
    scale = inertia.bound
    low, high = len(inertia.diagonal) * np.finfo(float).eps * scale, scale * (1 + 1e-9)
    found: list[tuple[float, float, int]] = []
    open_ = [(low, high, inertia.above(low), 0)]
    while open_:
        low, high, at_low, at_high = open_.pop()
        inside = at_low - at_high
        if not inside or at_high >= wanted:
            continue
        if (inside <= contour.most and at_low <= wanted + contour.most) or high - low < 1e-12 * scale:
            found.append((low, high, inside))
            continue
        middle = between(inertia, low, high)
        at_middle = inertia.above(middle)
        open_ += [(low, middle, at_low, at_middle), (middle, high, at_middle, at_high)]
    return found


def between(inertia: Inertia, low: float, high: float) -> float:
    """A shift near the middle of an interval, and not near an eigenvalue if there is such a place."""
    clear = (high - low) / 200
    for part in (0.5, 0.46, 0.54, 0.42, 0.58, 0.38, 0.62):
        shift = low + part * (high - low)
        if inertia.above(shift - clear) == inertia.above(shift + clear):
            return shift
    return (low + high) / 2


def pairs_inside(matrix: np.ndarray, low: float, high: float, count: int, contour: Contour) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, and their vectors as columns."""
    n, scale = len(matrix), np.abs(matrix).max()
    width = min(n, 2 * count + 4)
    points, weights = np.polynomial.legendre.leggauss(contour.nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - points))
    centre, radius = (low + high) / 2, (high - low) / 2
    while True:
        block = np.random.Generator(np.random.PCG64(11)).standard_normal((n, width))
        done = False
        for _ in range(contour.rounds):
            projected = np.zeros_like(block)
            for e, weight in zip(turn, weights):
                solved = np.linalg.solve((centre + radius * e) * np.eye(n) - matrix, block.astype(complex))
                projected += weight / 2 * (radius * e * solved).real
            basis = np.linalg.qr(projected)[0]
            values, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ mixed
            residual = np.linalg.norm(matrix @ block - block * values, axis=0)
            exact = (values > low) & (values <= high) & (residual <= contour.tolerance * n * scale)
            if exact.sum() == count and done:
                return values[exact], block[:, exact]
            done = exact.sum() == count  # one more round brings them down to rounding
        if width == n:
            raise ArithmeticError(f"{exact.sum()} of {count} eigenvalues found between {low} and {high}")
        width = min(n, 2 * width)


def largest(matrix: np.ndarray, wanted: int, contour: Contour = Contour()) -> tuple[np.ndarray, np.ndarray]:
    """At most ``wanted`` largest positive eigenvalues, falling, and unit eigenvectors as columns.

    Eigenvalues within rounding of zero are none. The entry of a vector that is largest in size is positive.
    """
    n = len(matrix)
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.empty(0), np.empty((n, 0))
    scaled = (matrix + matrix.T) / (2 * scale)
    inertia = Inertia(scaled)
    parts = [pairs_inside(scaled, *interval, contour) for interval in intervals(inertia, wanted, contour)]
    if not parts:
        return np.empty(0), np.empty((n, 0))
    # vectors of different intervals are orthogonal but for rounding; one last step over all of them makes them so
    basis = np.linalg.qr(np.concatenate([vectors for _, vectors in parts], axis=1))[0]
    values, mixed = np.linalg.eigh(basis.T @ scaled @ basis)
    order = np.argsort(-values)[:wanted]
    vectors = basis @ mixed[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * scale, vectors
