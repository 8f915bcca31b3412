"""Deterministic train / validation splits and resampling.

Membership is decided by a seeded hash order within each series, never by
``rand``, so a split is reproducible on any cluster layout.  Windows are
partitioned by the series key, whose partitions hold one row per period.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import hash_rank


def _hash_rank(df: DataFrame, key: list[str], period_col: str, seed: int) -> DataFrame:
    w = Window.partitionBy(*key)
    h = F.xxhash64(*[F.col(k) for k in key], F.col(period_col), F.lit(seed))
    return df.withColumns(
        {
            "_rank": F.row_number().over(w.orderBy(h, F.col(period_col))),
            "_idx": F.row_number().over(w.orderBy(period_col)),
            "_n": F.count(F.lit(1)).over(w),
        }
    )


def split_adjacent_pairs(
    grid: DataFrame, key: list[str], period_col: str, prop: float = 0.1, seed: int = 2222
) -> DataFrame:
    """Per series, sample ceil(prop*n) periods and add each one's next
    period (the previous one for the last), so validation holds adjacent pairs.
    Returns grid rows + ``validation_set``."""
    r = _hash_rank(grid, key, period_col, seed)
    picked = r.where(F.col("_rank") <= F.ceil(F.col("_n") * prop)).select(
        *key,
        F.explode(
            F.array(
                F.col("_idx"),
                F.when(F.col("_idx") < F.col("_n"), F.col("_idx") + 1).otherwise(F.col("_idx") - 1),
            )
        ).alias("_idx"),
    ).distinct().withColumn("validation_set", F.lit(True))
    return (
        r.join(picked, on=key + ["_idx"], how="left")
        .withColumn("validation_set", F.coalesce(F.col("validation_set"), F.lit(False)))
        .drop("_rank", "_idx", "_n")
    )


def split_sample(
    grid: DataFrame, key: list[str], period_col: str, prop: float = 0.2, seed: int = 2222
) -> DataFrame:
    """Per series, ceil(prop*n) periods in the validation set."""
    r = _hash_rank(grid, key, period_col, seed)
    return r.withColumn("validation_set", F.col("_rank") <= F.ceil(F.col("_n") * prop)).drop(
        "_rank", "_idx", "_n")


def attach_split(df: DataFrame, split: DataFrame, key: list[str]) -> DataFrame:
    """S3: membership joined onto the data (null = not covered by the split)."""
    return df.join(split.select(*key, "validation_set"), on=key, how="left")


def unassigned_rows(df: DataFrame) -> DataFrame:
    """S3 side output: rows the split does not cover."""
    return df.where(F.col("validation_set").isNull())


def training_rows(df: DataFrame) -> DataFrame:
    """training = validation_set is false (unassigned rows are dropped)."""
    return df.where(~F.col("validation_set")).drop("validation_set")


def validation_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("validation_set")).drop("validation_set")


def split_share(df: DataFrame) -> DataFrame:
    """S4 report: share of rows in validation, and countries missing from training."""
    return df.agg(
        F.avg(F.col("validation_set").cast("double")).alias("validation_share"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.countDistinct("country_iso3c")
         - F.countDistinct(F.when(~F.col("validation_set"), F.col("country_iso3c")))).alias(
            "countries_missing_from_training"),
    )


def stratified_folds(df: DataFrame, key: list[str], k: int = 10, strata: list[str] | None = None, seed: int = 400) -> DataFrame:
    """L4: ``fold`` (0 to k - 1) by rank in hash order within each stratum, so a stratum's fold sizes differ by one at most.

    Null strata form one of their own.  ``df`` is read three times: pass a
    materialised one.
    """
    ranked = hash_rank(df, key, strata or [], seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def bootstrap(df: DataFrame, key: list[str], seed: int = 42) -> DataFrame:
    """Resample with replacement: each row as often as a Poisson(1) draw of its seeded key hash.

    The draw depends on the key and the seed alone, not on the row's partition.
    """
    u = F.pmod(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    below, term, times = 0.0, math.exp(-1), F.lit(0)
    for k in range(1, 13):  # P(more than 12 draws) is below 1e-10
        below += term
        times = times + (u >= below).cast("int")
        term /= k
    return df.withColumn("_times", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)))).drop("_times")
