"""Eigenvectors of a symmetric matrix: single precision first, then corrected in higher precision.

The start is a float32 decomposition. Each step (Ogita and Aishima) takes from the approximate eigenvectors X the matrices
R = I - X'X and S = X'AX, reads better eigenvalues off their diagonals, and adds to X the correction X E, in which
E_ij = (S_ij + l_j R_ij) / (l_j - l_i) where the two eigenvalues are apart, and R_ij / 2 where they are not. The error
falls quadratically. Eigenvalues nearer to one another than the step can tell form clusters; the small matrix of each, with
the cluster's mean subtracted, is solved by itself and turns its vectors, after which the steps go on.
"""

from __future__ import annotations

import numpy as np

STEPS = 16              # at most; three or four are usual
EXTENDED_BELOW = 512    # up to this size the steps use extended precision, which has no fast matrix product

NOISE = 1e-9            # a correction made of rounding errors must stay below this, so its square is nothing


def clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of eigenvalues, grouped where neighbours in size are at most `apart` from each other; lone ones left out."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def _corrections(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The step's E, the eigenvalues, and how far two of these must be apart."""
    unit = np.eye(len(matrix), dtype=matrix.dtype)
    off = unit - vectors.T @ vectors
    form = vectors.T @ (matrix @ vectors)
    form = (form + form.T) / 2      # else rounding errors over small gaps would spoil E_ij + E_ji = R_ij
    values = np.diag(form) / (1 - np.diag(off))
    norm = lambda m: float(np.linalg.norm(m.astype(np.float64), 2))
    apart = 2 * (norm(form - np.diag(values)) + norm(matrix) * norm(off))
    apart = max(apart, norm(matrix) * len(matrix) * float(np.finfo(matrix.dtype).eps) / NOISE)
    gaps = values[None, :] - values[:, None]
    far = np.abs(gaps) > apart
    np.fill_diagonal(far, False)
    step = off / 2
    step[far] = ((form + values[None, :] * off)[far]) / gaps[far]
    return step, values, apart


def refined(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors to double precision, from approximate eigenvectors of a symmetric matrix."""
    kind = np.longdouble if len(matrix) <= EXTENDED_BELOW else np.float64
    matrix, vectors = matrix.astype(kind), vectors.astype(kind)
    before = np.inf
    for _ in range(STEPS):
        step, values, apart = _corrections(matrix, vectors)
        size = float(np.abs(step).max(initial=0))
        vectors = vectors + vectors @ step
        if size < 1e-13 and size >= before / 2:     # as exact as the arithmetic lets it be
            break
        before = size
        for group in clusters(values.astype(np.float64), apart):
            own = vectors[:, group]
            shifted = own.T @ (matrix @ own) - values[group].mean() * (own.T @ own)
            scale = np.abs(shifted).max()
            if scale > 0:
                _, turn = np.linalg.eigh(((shifted + shifted.T) / (2 * scale)).astype(np.float64))
                vectors[:, group] = own @ turn.astype(kind)
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    values = (vectors * (matrix @ vectors)).sum(0)
    return values.astype(np.float64), vectors.astype(np.float64)


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their unit eigenvectors as columns, each with its largest entry positive."""
    scale = float(np.abs(matrix).max(initial=0))
    if scale == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    _, start = np.linalg.eigh((matrix / scale).astype(np.float32))
    values, vectors = refined(matrix / scale, start)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * scale, vectors[:, order]
    lead = vectors[np.abs(vectors).argmax(0), np.arange(len(matrix))]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)
