"""Exact ranks, quantiles and samples without a window over all rows.

Two layouts give exact ranks with bounded tasks:

- ``hash_rank``: rows in the order of an MD5 of their key.  MD5 values are
  uniform, so their leading hexadecimal digits are ranges of about equal size;
  a row's rank is its place in its range plus the sizes of the ranges before.
- ``value_ranks``: rows in the order of a value.  Equal values are counted
  together first, so a hot value is one row; the distinct values are sorted by
  range and get the offsets of the partitions before.

Both need one row per range (or partition) and group for the offsets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage

RANGE_ROWS = 1 << 20  # rows of a hash range, about


def key_hash(key: list[str], seed: int) -> Column:
    """MD5 of the seed and the key's values as text, joined by ``|`` (nulls left out)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]).cast("binary"))


def _same(left: str, right: str, cols: list[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]


def hash_rank(df: DataFrame, key: list[str], by: list[str], seed: int, out: str = "rank", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with the rank (from 1) of each row within its group in the order of (``key_hash``, key).

    ``by`` may be empty or hold nulls (a group of their own); rows of equal keys
    get consecutive ranks in any order.  ``df`` is read three times: pass a
    materialised one.
    """
    digits = max(1, math.ceil(math.log(max(1, df.count() / range_rows), 16)))
    hashed = df.withColumn("_hash", key_hash(key, seed)).withColumn("_range", F.substring("_hash", 1, digits))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*by, "_range").orderBy("_hash", *key)
    ranked = hashed.withColumn("_inside", F.row_number().over(inside))
    joined = ranked.alias("r").join(offsets.alias("o"), _same("r", "o", [*by, "_range"]))
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("_before") + F.col("_inside")).alias(out))


def hash_sample(df: DataFrame, key: list[str], n: int, seed: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The ``n`` rows with the smallest ``key_hash`` (all, if there are fewer), whatever their layout.

    A histogram of the leading digits finds the range that holds the ``n``-th
    hash; only that range is sorted, and one filter takes the rows.  Keys should
    be unique: rows that share the last hash are all taken.
    """
    digits = max(1, math.ceil(math.log(max(1, df.count() / range_rows), 16)))
    digest = key_hash(key, seed)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(F.substring(digest, 1, digits).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    last = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(
        (F.col("_before") < n) & (n <= F.col("_before") + F.col("_n"))).first()
    if n <= 0:
        return df.limit(0)
    if last is None:
        return df
    inside = df.select(digest.alias("_hash")).where(F.substring("_hash", 1, digits) == last["_range"])
    edge = inside.orderBy("_hash").offset(n - last["_before"] - 1).limit(1).first()["_hash"]
    return df.where(digest <= edge)


def value_ranks(values: DataFrame, by: list[str], value: str, count: str, name: str = "value_ranks") -> DataFrame:
    """Distinct values with the number of rows below each.

    ``values`` has one row per group and distinct value, with its number of rows
    in ``count``; the result adds ``_lo`` (rows of the group with a smaller
    value) and ``_total`` (rows of the group), as a written stage.
    """
    ordered = write_stage(
        values.orderBy(*by, value).withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)), name)
    sums = ordered.groupBy(*by, "_part").agg(F.sum(count).alias("_s"))  # a row per group and partition
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumns({
        "_before": F.coalesce(F.sum("_s").over(before), F.lit(0)),
        "_total": F.sum("_s").over(Window.partitionBy(*by)),
    }).drop("_s")
    inside = Window.partitionBy("_part", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ordered.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0))).alias("v").join(
        offsets.alias("o"), _same("v", "o", [*by, "_part"]))
    return write_stage(
        ranked.select(*[F.col(f"v.{c}") for c in values.columns], (F.col("_before") + F.col("_inside")).alias("_lo"), "_total"), name)


def exact_quantile(df: DataFrame, value: str, q: float, by: list[str] | None = None) -> DataFrame:
    """(by..., quantile): the linearly interpolated quantile of the non-null values of each group.

    The value at 0-based rank ``q (n - 1)`` of n sorted values, between
    neighbours in proportion.  Groups without values are left out.
    """
    if not 0 <= q <= 1:
        raise ValueError("a quantile is between 0 and 1")
    by = by or []
    keys = by or ["_all"]
    known = df.where(F.col(value).isNotNull()).withColumn("_all", F.lit(0))
    ranked = value_ranks(known.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), keys, "_v", "_n")
    place = F.lit(float(q)) * (F.col("_total") - 1)
    holds = lambda at: (F.col("_lo") <= at) & (at < F.col("_lo") + F.col("_n"))
    ends = ranked.where(holds(F.floor(place)) | holds(F.ceil(place))).groupBy(*keys).agg(
        F.min("_v").alias("_below"), F.max("_v").alias("_above"), F.first(place - F.floor(place)).alias("_part"))
    return ends.select(*by, (F.col("_below") + (F.col("_above") - F.col("_below")) * F.col("_part")).alias("quantile"))
