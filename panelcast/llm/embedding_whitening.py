"""Whitening of embeddings: principal components by FEAST contour integration.

Entries are fixed-point numbers, so sums and products over the vectors are exact
integers and the covariance does not depend on their order:

1. every entry c becomes ``floor(scale * c)``; the fit list, each distinct
   vector once, is written;
2. one pass gives the count and sums, a second one the products of the vectors
   less their rounded mean, from which the covariance centred at the exact mean
   follows without cancellation;
3. the dimension x dimension covariance (its size does not grow with the rows)
   is decomposed by ``top_components``;
4. all rows are projected.

``top_components`` is FEAST.  Sturm sequences of the tridiagonal form give the
inertia of V - s I, the number of eigenvalues above s; bisection on this count
places an interval that holds the wanted ones.  A contour around the interval
is integrated by Gauss-Legendre quadrature: the sum of the complex shifted
solves ``(z I - V)^-1 Y`` projects Y onto the interval's eigenvectors.
Rayleigh-Ritz on the projected space extracts the components; the step is
repeated until residuals are at rounding level.  The number of Ritz values in
the interval must equal the difference of the inertia counts, otherwise the
space is enlarged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_stage

SCALE = 256
COMPONENTS = 4
NODES = 8  # quadrature nodes on the half circle
ROUNDS = 30
EXACT = 1 << 53  # integers below it are exact doubles
ROWS = 1 << 12  # vectors multiplied at a time


# ---- FEAST ---------------------------------------------------------------------------------
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix's tridiagonal form (Householder)."""
    a, d = v.copy(), len(v)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        y = rest @ x
        y -= (x @ y) * x
        rest -= 2 * (np.outer(x, y) + np.outer(y, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the tridiagonal form less the shift."""
    diagonal, off = form
    tiny = np.finfo(float).tiny * 4
    pivot, above = diagonal[0] - shift, 0
    for k in range(len(diagonal)):
        if k:
            pivot = diagonal[k] - shift - off[k - 1] ** 2 / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return int(above)


def lower_edge(form: tuple[np.ndarray, np.ndarray], wanted: int, low: float, high: float) -> float:
    """A shift with ``wanted`` eigenvalues above it, inside the widest gap that bisection leaves.

    Where equal eigenvalues straddle the count, all of them are above.
    """
    a, b = low, high  # above a: wanted or more; above b: fewer
    while b - a > 4 * np.finfo(float).eps * max(abs(low), abs(high)):
        middle = (a + b) / 2
        if not a < middle < b:
            break
        above = count_above(form, middle)
        if above >= wanted:
            a = middle
        else:
            b = middle
    last, under = a, low  # the lowest wanted eigenvalue is just above ``last``; find the next lower one
    total = count_above(form, last)
    top = last
    while top - under > 1e-3 * (high - under):
        middle = (under + top) / 2
        if count_above(form, middle) > total:
            under = middle
        else:
            top = middle
    return (top + last) / 2


def _project(v: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """Quadrature of the resolvent over the circle on [low, high], applied to ``y``."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    out, identity = np.zeros_like(y), np.eye(len(v))
    for t, w in zip(nodes, weights):
        turn = np.exp(1j * np.pi * (1 - t) / 2)  # the lower half circle gives the conjugates
        out += w / 2 * radius * (turn * np.linalg.solve((centre + radius * turn) * identity - v, y)).real
    return out


def top_components(v: np.ndarray, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric non-negative matrix, falling, and their unit eigenvectors as columns.

    At most ``wanted``; eigenvalues of zero, to rounding, are left out.  Each
    eigenvector's entry of largest size is positive.  Raises if, after all
    rounds, the interval's inertia still counts eigenvalues that were not found.
    """
    d, size = len(v), float(np.abs(v).sum(axis=1).max(initial=0.0))
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    v = v / size  # eigenvalues at most 1
    form = tridiagonal(v) if d > 1 else (v[0, :1].copy(), np.zeros(0))
    zero = 16 * d * np.finfo(float).eps
    wanted = min(wanted, count_above(form, zero))
    low, high = lower_edge(form, wanted, zero if count_above(form, zero) == wanted else -zero, 1 + zero), 1 + 2 * zero
    inside = count_above(form, low) - count_above(form, high)
    space, rng = min(d, 2 * inside + 4), np.random.default_rng(seed)
    y, best = rng.standard_normal((d, space)), None
    for _ in range(ROUNDS):
        q = np.linalg.qr(_project(v, y, low, high))[0]
        ritz, turn = np.linalg.eigh(q.T @ v @ q)
        y = q @ turn
        held = (ritz > low) & (ritz <= high)
        if held.sum() < inside:
            if space < d:  # one was missed: a larger space
                space = min(d, 2 * space)
                y = np.concatenate([y, rng.standard_normal((d, space - y.shape[1]))], axis=1)
            continue
        values, vectors = ritz[held][::-1][:wanted], y[:, held][:, ::-1][:, :wanted]
        residual = float(np.linalg.norm(v @ vectors - vectors * values, axis=0).max())
        if best is None or residual < best[0]:
            best = (residual, values, vectors)
        elif residual <= 1e-13:  # no better than the round before: at rounding level
            break
    if best is None or best[0] > 1e-9:
        raise ArithmeticError(f"{inside} eigenvalues counted, not all found")
    _, values, vectors = best
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values * size, vectors * sign


# ---- exact sums ----------------------------------------------------------------------------
def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _product(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y`` of integers, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for a in range(0, len(y), ROWS):
        part = y[a : a + ROWS]
        if _largest(part) ** 2 * len(part) < EXACT:
            total += (part.T.astype(float) @ part.astype(float)).astype(np.int64)
        else:
            part = part.astype(object)
            total += part.T @ part
    return total


def _sums(d: int, centre: list[int] | None):
    """Partial sums of a task: of the entries, or of the products of entries less ``centre``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0), d)
            rows += len(x)
            if centre is None:
                part = x.sum(axis=0) if _largest(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
                part = part.astype(object)
            else:
                part = _product(x - np.array(centre, dtype=np.int64))[np.triu_indices(d)]
            total = part if total is None else total + part
        if total is not None:
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows], pa.int64()), pa.array([list(map(int, total))], pa.list_(pa.int64())).cast(pa.list_(kind))
                 if max(map(abs, total)) < 1 << 62 else pa.array([[_decimal(t) for t in total]], pa.list_(kind))], names=["n", "s"])

    return run


def _decimal(x: int):
    from decimal import Decimal

    return Decimal(int(x))


def _totals(fit: DataFrame, d: int, centre: list[int] | None = None) -> tuple[int, list[int]]:
    parts = fit.mapInArrow(_sums(d, centre), "n long, s array<decimal(38,0)>")
    rows = parts.select("n", F.posexplode("s").alias("k", "s")).groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("k").collect()  # one row per entry of the result
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # falling eigenvalues
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def fixed_point(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """The vector is there and has finite entries only."""
    entries = vector.cast("array<double>")
    return F.coalesce(F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def fit(vectors: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors of column ``x`` (array<long>); null without any vector or dimension."""
    lengths = vectors.agg(F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    if lengths["a"] != lengths["b"]:
        raise ValueError(f"vectors of {lengths['a']} to {lengths['b']} entries")
    d = lengths["b"]
    if not d:
        return None
    n, sums = _totals(vectors, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    _, products = _totals(vectors, d, centre)
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.zeros((d, d))
    for (i, j), p in zip(zip(*np.triu_indices(d)), products):
        v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / (n * n)  # exact integers, one rounding
    values, columns = top_components(v, wanted)
    return Whitening(n, sums, values, columns, float(np.trace(v)))


# ---- projection ----------------------------------------------------------------------------
def _whiten(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates, a column per component; the mean is split so that no digits are lost."""
    whole = np.array([s // model.n for s in model.sums], dtype=np.int64)
    part = np.array([(s % model.n) / model.n for s in model.sums])
    return ((x - whole).astype(float) - part) @ model.vectors / np.sqrt(model.values)


def _deviation(x: np.ndarray, model: Whitening) -> list:
    bound = model.n * _largest(x) + max(map(abs, model.sums))
    kind = np.int64 if bound**2 * model.dimension < 1 << 62 else object
    apart = x.astype(kind) * model.n - np.array(model.sums, dtype=kind)
    return list(map(int, (apart * apart).sum(axis=1)))


def _projector(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), model.dimension)
            z = _whiten(x, model)
            offsets = pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_decimal, _deviation(x, model)), pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(offsets, pa.array(z.reshape(-1)))], names=["id", "deviation", "z"])

    return run


def _moments(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            z = _whiten(_matrix(batch.column(0), model.dimension), model)
            total = total + np.concatenate([(z.T @ z).reshape(-1), z.sum(axis=0)])
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["m"])

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured over the fit list."""
    k = len(model.values)
    if not k:
        return 0.0
    parts = vectors.mapInArrow(_moments(model), "m array<double>").select(F.posexplode("m").alias("k", "m"))
    sums = [r["m"] for r in parts.groupBy("k").agg(F.sum("m").alias("m")).orderBy("k").collect()]
    products, means = np.array(sums[: k * k]).reshape(k, k) / model.n, np.array(sums[k * k :]) / model.n
    return float(np.abs(products - np.outer(means, means) - np.eye(k)).max())


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """A row per usable vector and component: (``id_col``, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null or hold null or non-finite entries are dropped.
    Components beyond the rank of the covariance (equal vectors, few rows) have
    null ``whitened`` and an ``explained`` of 0, null if all vectors are equal;
    there are as many as dimensions, ``wanted`` at most.  Repeated vectors are
    fitted once but all returned, null and repeated ids too; other columns are
    left out.  Tables without usable vectors, or with empty ones, give an empty
    result; vectors of different lengths raise.
    """
    given = rows.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), fixed_point(F.col(vector_col), scale).alias("x"))
    distinct = write_stage(given.select("x").distinct(), "whitening-fit")
    model = fit(distinct, wanted)
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, deviation decimal(38,0), z array<double>"
    if model is None:
        model = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
        out = given.limit(0).select("id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("z"))
    else:
        out = given.mapInArrow(_projector(model), schema)
    shares = [float(e) / model.trace for e in model.values] if model.trace else []
    shares += [0.0 if model.trace else None] * (min(wanted, model.dimension) - len(shares))
    components = F.array(*[
        F.struct(F.lit(k + 1).alias("component"), F.lit(s).cast("double").alias("explained")) for k, s in enumerate(shares)
    ]) if shares else F.array().cast("array<struct<component: int, explained: double>>")
    return out.select("id", "deviation", "z", F.explode(components).alias("c")).select(
        F.col("id").alias(id_col), "c.component", F.lit(model.n).cast("long").alias("n"), "deviation",
        F.get("z", F.col("c.component") - 1).alias("whitened"), "c.explained",
        F.lit(identity_error(distinct, model)).alias("identity_error"))
