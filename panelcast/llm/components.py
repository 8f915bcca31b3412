"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node with a link to another; root is the smallest reachable id.

    ``edges`` has two long columns.  Each round re-hangs every node's larger
    neighbours, then its smaller ones, on its least neighbour, and is written
    to the shared stage folder; the number of rounds grows with the logarithm
    of the longest chain.  Minima combine on the map side, so a node of any
    degree is one row per task before the shuffle.
    """
    a, b = edges.columns
    links = write_stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "links"
    )
    while not _is_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = write_stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = links.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _is_stars(links: DataFrame) -> bool:
    """Every node hangs on one other that hangs on none."""
    state = (
        links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        .unionByName(links.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        .groupBy("n")
        .agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        .agg(F.max(F.col("up") + F.col("down") * (F.col("up") > 0).cast("int")).alias("worst"))
        .first()["worst"]
    )
    return state is None or state <= 1
