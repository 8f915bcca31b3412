"""Shared helpers of the learned scorers: splits, bounded labelled samples, logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def held_out(id_col: str) -> Column:
    """True where no label may be learned: fold 0, and rows without an id."""
    return F.coalesce(fold(id_col) == 0, F.lit(True))


def bounded_sample(rows: DataFrame, label: str, per_label: int, id_col: str) -> DataFrame:
    """About ``per_label`` rows of each label, the same ones in every run.

    Counts per label are over all rows; a row is taken when the hash of its id
    falls below its label's share.  Labels with fewer rows give all of them.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_label / n))]) if counts else None
    if share is None:
        return rows.limit(0)
    at = (F.xxhash64(F.col(id_col).cast("string")).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    return rows.filter(at < share[F.col(label)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-5, rounds: int = 120, floor: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of independent logistic models, one per column of ``y`` (0/1).

    Accelerated full-batch descent with the step of the data's own curvature
    bound.  ``floor`` bounds all weights from below.
    """
    n, d = x.shape
    w, b = np.zeros((d, y.shape[1]), dtype=x.dtype), np.zeros(y.shape[1])
    step = 4.0 / max(1.0, float(np.einsum("ij,ij->i", x, x).mean()) + 1.0)
    vw, vb, t = w, b, 1.0
    for _ in range(rounds):
        error = ((sigmoid(x @ vw + vb) - y) / n).astype(x.dtype)  # products stay in the type of ``x``
        nw, nb = vw - step * (x.T @ error + l2 * vw), vb - step * error.sum(axis=0)
        if floor is not None:
            nw = np.maximum(nw, floor)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + float((t - 1) / nt) * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b
