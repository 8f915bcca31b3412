"""Outbreak extent: UTM projection and the bounding (smallest enclosing
circle) radius per group (P9).

Projection is a column expression (transverse Mercator series on WGS84,
Snyder 1987) so it runs in codegen.  The radius needs a geometric routine,
for groups that fit a task run in a streaming pandas function, for larger ones
taken from rounds of farthest points, so that no task ever holds a hot group.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_stage

# WGS84 / UTM constants (fixed values of the projection)
A_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563
K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0


def utm_zone(lon: Column) -> Column:
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def utm_xy(lat: Column, lon: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """Forward transverse Mercator (series form) into the given UTM zone."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    e4, e6 = e2 * e2, e2 * e2 * e2
    phi = F.radians(lat)
    lam0 = F.radians((zone - 1) * 6 - 180 + 3)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    n = F.lit(A_AXIS) / F.sqrt(1 - e2 * sin * sin)
    t = tan * tan
    c = ep2 * cos * cos
    a = cos * (F.radians(lon) - lam0)
    m = A_AXIS * (
        (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )
    x = K0 * n * (
        a + (1 - t + c) * F.pow(a, 3) / 6
        + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120
    ) + FALSE_EASTING
    y = K0 * (
        m + n * tan * (
            a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24
            + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720
        )
    )
    y = F.when(north, y).otherwise(y + FALSE_NORTHING_SOUTH)
    return x, y


# ---- geometry (numpy, per group) ------------------------------------------------
def convex_hull(pts: np.ndarray) -> np.ndarray:
    """Andrew's monotone chain; returns hull vertices (collinear dropped)."""
    pts = np.unique(pts, axis=0)
    if len(pts) <= 2:
        return pts
    pts = pts[np.lexsort((pts[:, 1], pts[:, 0]))]

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    lower, upper = [], []
    for p in pts:
        while len(lower) >= 2 and cross(lower[-2], lower[-1], p) <= 0:
            lower.pop()
        lower.append(p)
    for p in pts[::-1]:
        while len(upper) >= 2 and cross(upper[-2], upper[-1], p) <= 0:
            upper.pop()
        upper.append(p)
    return np.array(lower[:-1] + upper[:-1])


def _circle2(a, b):
    c = (a + b) / 2
    return c, float(np.hypot(*(a - c)))


def _circle3(a, b, c):
    origin = (a + b + c) / 3  # coordinates are millions of metres: work near the origin
    a, b, c = a - origin, b - origin, c - origin
    d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
    if abs(d) <= 1e-12 * max(a @ a, b @ b, c @ c):
        # collinear: the two farthest points span the circle
        pairs = [(a, b), (a, c), (b, c)]
        centre, radius = max((_circle2(p, q) for p, q in pairs), key=lambda t: t[1])
        return centre + origin, radius
    ux = ((a @ a) * (b[1] - c[1]) + (b @ b) * (c[1] - a[1]) + (c @ c) * (a[1] - b[1])) / d
    uy = ((a @ a) * (c[0] - b[0]) + (b @ b) * (a[0] - c[0]) + (c @ c) * (b[0] - a[0])) / d
    centre = np.array([ux, uy])
    return centre + origin, float(np.hypot(*(a - centre)))


def enclosing_radius(pts: np.ndarray) -> float:
    """Exact smallest enclosing circle radius (Welzl, fixed shuffle)."""
    pts = np.unique(np.asarray(pts, dtype=float), axis=0)
    n = len(pts)
    if n == 0:
        return float("nan")
    if n == 1:
        return 0.0
    if n == 2:
        return _circle2(pts[0], pts[1])[1]
    p = pts[np.random.default_rng(0).permutation(n)]
    eps = 1e-7

    def inside(q, c, r):
        return math.hypot(q[0] - c[0], q[1] - c[1]) <= r * (1 + 1e-12) + eps

    c, r = p[0], 0.0
    for i in range(1, n):
        if not inside(p[i], c, r):
            c, r = p[i], 0.0
            for j in range(i):
                if not inside(p[j], c, r):
                    c, r = _circle2(p[i], p[j])
                    for k in range(j):
                        if not inside(p[k], c, r):
                            c, r = _circle3(p[i], p[j], p[k])
    return float(r)


def _stream_runs(batches, key: list[str], fn, out_cols: list[str]):
    """Apply ``fn(x, y) -> list of (x, y)-or-value rows`` to each key-run of a
    key-sorted partition, streaming.

    Arrow batches may cut a group in two; the trailing run of a batch is
    carried into the next one, so a group is never split and a partition is
    never held whole.  Work per group is numpy slicing (no per-group frames).
    """
    carry = None
    for pdf in batches:
        if carry is not None and len(carry):
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if pdf.empty:
            continue
        ids = pdf.groupby(key, sort=False, dropna=False).ngroup().to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        last_start = starts[-1]
        carry = pdf.iloc[last_start:]
        if last_start == 0:
            continue
        done = pdf.iloc[:last_start]
        yield _apply_runs(done, starts[:-1], last_start, key, fn, out_cols)
    if carry is not None and len(carry):
        yield _apply_runs(carry, np.array([0]), len(carry), key, fn, out_cols)


def _apply_runs(pdf, starts, end, key, fn, out_cols):
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
    bounds = list(starts) + [end]
    rows_idx, vals = [], []
    for i in range(len(starts)):
        s0, s1 = bounds[i], bounds[i + 1]
        for v in fn(x[s0:s1], y[s0:s1]):
            rows_idx.append(s0)
            vals.append(v)
    keys = pdf[key].iloc[rows_idx].reset_index(drop=True)
    vals_df = pd.DataFrame(vals, columns=[c for c in out_cols if c not in key])
    return pd.concat([keys, vals_df], axis=1)[out_cols]


def _radius_rows(x, y):
    return [(enclosing_radius(convex_hull(np.column_stack([x, y]))),)]


def bounding_radius(
    points: DataFrame,
    key: list[str],
    lat: str = "latitude",
    lon: str = "longitude",
    points_per_task: int = 200_000,
) -> DataFrame:
    """Per group, radius of the smallest circle enclosing its distinct points,
    in metres in the UTM zone of the group's mean point (0 for one point,
    half the distance for two).

    One and two points are solved in columns.  Groups of up to
    ``points_per_task`` points are reduced to their convex hull in a streaming
    pass over key-sorted partitions (the enclosing circle of a set is that of its
    hull).  Larger groups are never brought together: ``_large_radius`` finds
    their circles from farthest points, which combine on the map side.
    """
    pts = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        *key, F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")
    ).distinct()
    pts = write_stage(pts, "radius_distinct")  # read for the means, the sizes and the points of each kind of group
    stats = pts.groupBy(*key).agg(
        F.avg("lat").alias("_mlat"), F.avg("lon").alias("_mlon"), F.count(F.lit(1)).alias("_n"))
    proj = pts.join(stats, on=key, how="inner")
    x, y = utm_xy(F.col("lat"), F.col("lon"), utm_zone(F.col("_mlon")), F.col("_mlat") > 0)
    xy = proj.select(*key, x.alias("x"), y.alias("y"), "_n")
    out_schema = T.StructType([f for f in xy.schema.fields if f.name in key] + [T.StructField("outbreak_radius", T.DoubleType())])
    out_cols = [f.name for f in out_schema.fields]

    def radius_pass(batches):
        yield from _stream_runs(batches, key, _radius_rows, out_cols)

    few = xy.where(F.col("_n") <= 2).groupBy(*key).agg(
        (F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")) / 2).alias("outbreak_radius"))
    some = xy.where((F.col("_n") > 2) & (F.col("_n") <= points_per_task)).select(*key, "x", "y")
    many = some.repartition(*key).sortWithinPartitions(*key).mapInPandas(radius_pass, out_schema)
    out = few.select(*out_cols).unionByName(many)
    if not stats.where(F.col("_n") > points_per_task).isEmpty():
        out = out.unionByName(_large_radius(xy.where(F.col("_n") > points_per_task).select(*key, "x", "y"), key).select(*out_cols))
    return out


ROUND_TOLERANCE = 1e-9  # of the radius: a point so near the circle is on it


def _support(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The circle around a few points and the points (three at most) that determine it."""
    best = None
    for n in (1, 2, 3):
        for which in combinations(range(len(points)), n):
            chosen = points[list(which)]
            if n == 3:
                circle = _circle3(*chosen)
                if circle is None:
                    continue
                centre, radius = circle
            else:
                centre, radius = (chosen[0], 0.0) if n == 1 else _circle2(*chosen)
            centre = np.asarray(centre, dtype=float)
            far = np.hypot(*(points - centre).T).max()
            if far <= radius * (1 + 1e-12) + 1e-9 and (best is None or radius < best[2]):
                best = (chosen, centre, float(radius))
    return best


def _circles(key: list[str]):
    def run(batches):
        for pdf in batches:
            rows = []
            for pts in pdf["pts"]:
                found = np.unique(np.array([(p["x"], p["y"]) for p in pts], dtype=float), axis=0)
                support, centre, radius = _support(found)
                rows.append(([{"x": float(a), "y": float(b)} for a, b in support], float(centre[0]), float(centre[1]), radius))
            yield pd.concat([pdf[key].reset_index(drop=True), pd.DataFrame(rows, columns=["pts", "cx", "cy", "r"])], axis=1)

    return run


def _large_radius(xy: DataFrame, key: list[str]) -> DataFrame:
    """Enclosing radius of large groups in rounds of one aggregate each.

    A group's state is the (at most three) points that determine its circle so
    far.  A round finds each group's point farthest from its centre, partially
    aggregated in every task; where it lies outside, the circle of state and
    point replaces the old one, whose radius is smaller.  Radii grow strictly, so
    the rounds end, in practice after about ten.
    """
    xy = write_stage(xy, "radius_points")
    corner = [F.struct(F.col("x"), F.col("y"))] * 4
    ends = [F.min_by(corner[0], "x"), F.max_by(corner[1], "x"), F.min_by(corner[2], "y"), F.max_by(corner[3], "y")]
    schema = T.StructType([
        *[f for f in xy.schema.fields if f.name in key], T.StructField("pts", T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))),
        T.StructField("cx", T.DoubleType()), T.StructField("cy", T.DoubleType()), T.StructField("r", T.DoubleType())])
    first = xy.groupBy(*key).agg(F.array(*ends).alias("pts"))
    state = write_stage(first.mapInPandas(_circles(key), schema), "radius_state")
    done = []
    while True:
        same = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]
        away = F.hypot(F.col("p.x") - F.col("s.cx"), F.col("p.y") - F.col("s.cy"))
        seen = xy.alias("p").join(state.alias("s"), same).select(*[F.col(f"s.{k}") for k in key], F.col("p.x"), F.col("p.y"), away.alias("away"))
        farthest = seen.groupBy(*key).agg(F.max_by(F.struct("x", "y"), "away").alias("point"), F.max("away").alias("away"))
        both = state.alias("s").join(farthest.alias("p"), same).select("s.*", "point", "away")
        both = write_stage(both, "radius_round")
        outside = F.col("away") > F.col("r") * (1 + ROUND_TOLERANCE) + 1e-7
        done.append(both.where(~outside).select(*key, F.col("r").alias("outbreak_radius")))
        left = both.where(outside)
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        grown = left.select(*key, F.concat("pts", F.array("point")).alias("pts"))
        state = write_stage(grown.mapInPandas(_circles(key), schema), "radius_state")
