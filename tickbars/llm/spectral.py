"""Eigenvectors of a symmetric matrix by divide and conquer on its spectrum.

The polar factor of ``A - m I`` has eigenvalue 1 where A's is above m and -1 where it
is below, so half of it plus half of the identity projects on one side.  The factor
comes from the dynamically weighted Halley iteration (QDWH), which needs nothing but QR
factors.  Bases of the two sides give two smaller matrices, split in the same way.
The matrix is one of dimensions by dimensions, whatever the number of rows behind it.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
SHIFTS = (0.0, 0.03, -0.03, 0.11, -0.11, 0.23, -0.23, 0.37, -0.37)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    n, size = len(a), np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x, low = a / size, EPS / 4
    for _ in range(30):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        factor = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(n)]))[0]
        new = q / r * x + (p - q / r) / np.sqrt(r) * factor[:n] @ factor[n:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (p + q * square) / (1 + r * square))
        done = np.linalg.norm(new - x) < 8 * EPS * np.sqrt(n) and 1 - low < 8 * EPS
        x = new
        if done:
            break
    return x


def _sides(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces above and below a value within the spectrum."""
    n, diagonal = len(a), np.diag(a)
    spread = np.linalg.norm(a - np.eye(n) * diagonal.mean()) / np.sqrt(n)
    noise = np.random.default_rng(n).standard_normal((n, n))
    best = None
    # The median balances the halves; the mean is always inside the spectrum.  A value too near an
    # eigenvalue leaves no clear projector: then the next one is tried.
    for middle in (np.median(diagonal), diagonal.mean()):
        for shift in SHIFTS:
            onto = (polar(a - (middle + shift * spread) * np.eye(n)) + np.eye(n)) / 2
            k = int(round(np.trace(onto)))
            if not 0 < k < n:
                continue
            error = np.linalg.norm(onto @ onto - onto)
            if best is None or error < best[0]:
                best = error, onto, k
            if error < 1e-12 * n:
                break
        if best and best[0] < 1e-12 * n:
            break
    if best is None:
        raise ArithmeticError("no value splits the spectrum")
    _, onto, k = best
    above = np.linalg.qr(onto @ noise[:, :k])[0]
    whole = np.linalg.qr(onto @ above, mode="complete")[0]
    above, below = whole[:, :k], whole[:, k:]
    return above, np.linalg.qr(below - above @ (above.T @ below))[0]


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the symmetric matrix *a*, falling, and unit eigenvectors as columns.

    The entry of largest size in each column is positive.  Within equal eigenvalues the
    vectors are some orthonormal basis.
    """
    n = len(a)
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)
    values, vectors, waiting = [], [], [np.eye(n)] if n else []
    while waiting:
        basis = waiting.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        rest = part - np.diag(np.diag(part))
        if len(part) == 1 or np.linalg.norm(rest) <= EPS * scale:
            values.append(np.diag(part))
            vectors.append(basis)
            continue
        above, below = _sides(part)
        # Against the drift of long products: an orthonormal basis again.
        waiting += [np.linalg.qr(basis @ above)[0], np.linalg.qr(basis @ below)[0]]
    if not values:
        return np.empty(0), np.empty((0, 0))
    value, vector = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-value, kind="stable")
    value, vector = value[order], vector[:, order]
    largest = vector[np.abs(vector).argmax(axis=0), np.arange(n)]
    return value, vector * np.where(largest < 0, -1.0, 1.0)
