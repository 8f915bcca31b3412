"""Bounding radius of large groups, in rounds of farthest points."""

import numpy as np
from pyspark.sql import functions as F

from panelcast.operators import spatial


def radii(xy, key=("g",)):
    return {r["g"]: r["outbreak_radius"] for r in spatial._large_radius(xy, list(key)).collect()}


def test_rounds_match_the_exact_circle(spark):
    rng = np.random.default_rng(3)
    clouds = {f"c{i}": rng.normal(size=(int(n), 2)) * rng.uniform(1, 1e4, 2) + 5e6 for i, n in enumerate(rng.integers(3, 400, 12))}
    clouds["line"] = np.stack([np.arange(50.0), 2 * np.arange(50.0)], axis=1)
    clouds["same"] = np.full((9, 2), 7.0)
    clouds[None] = np.array([[0, 0], [6, 0], [3, 1], [3, -5.0]])
    rows = [(g, float(a), float(b)) for g, pts in clouds.items() for a, b in pts]
    got = radii(spark.createDataFrame(rows, "g string, x double, y double").repartition(5))
    assert set(got) == set(clouds)
    for g, pts in clouds.items():
        assert abs(got[g] - spatial.enclosing_radius(pts)) <= 1e-8 * (1 + got[g]), g


def test_a_million_points_on_a_circle(spark):
    turn = F.col("id") * 2.399963229728653  # golden angle: points everywhere on it
    xy = spark.range(1_000_000).select(F.lit("ring").alias("g"), (F.cos(turn) * 250.0 + 4e5).alias("x"), (F.sin(turn) * 250.0 + 5e6).alias("y"))
    assert abs(radii(xy)["ring"] - 250.0) < 1e-4
