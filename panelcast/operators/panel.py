"""Panel operators: densify, lag, "ever before", first period.

The series key of a panel is unique per period after roll-up, so every
window partition below holds at most one row per period; no window sees a
hot key's raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, col: str) -> Column:
    """All distinct values of a dimension column, as one array in a scalar subquery.

    Nulls count as a value.  The values combine on the map side; the plan
    neither collects them nor holds them as literals.
    """
    found = df.agg(F.collect_set(F.struct(F.col(col).alias("v"))).alias("s"))
    return found.select(F.transform("s", lambda s: s["v"])).scalar()


def dense_grid(
    facts: DataFrame,
    entity_cols: list[str],
    region_col: str,
    period_col: str,
    period_start,
    period_end,
    step: Column | None = None,
) -> DataFrame:
    """Every observed entity x every region x every period, left-joined to facts.

    ``period_start`` / ``period_end`` are literals (ints, or dates with a
    ``step`` interval).  The grid is generated per entity with two
    ``explode`` generators (regions from one aggregated array of the distinct
    ones, periods from ``sequence``), so no row pairs are formed; the single
    shuffle is the left join with the facts on the full key.  Empty facts give
    an empty grid.
    The output has a boolean ``_observed`` column telling real cells apart.
    """
    seq = (
        F.sequence(F.lit(period_start), F.lit(period_end), step)
        if step is not None
        else F.sequence(F.lit(period_start), F.lit(period_end))
    )
    grid = (
        facts.select(*entity_cols)
        .distinct()
        .withColumn(region_col, F.explode(distinct_values(facts, region_col)))
        .withColumn(period_col, F.explode(seq))
    )
    key = entity_cols + [region_col, period_col]
    return grid.join(facts.withColumn("_observed", F.lit(True)), on=key, how="left").withColumn(
        "_observed", F.coalesce(F.col("_observed"), F.lit(False))
    )


def panel_lag(
    df: DataFrame, series_cols: list[str], order_col: str, cols: list[str], n: int
) -> DataFrame:
    """Lags 1..n of each column within a series ordered by ``order_col``."""
    w = Window.partitionBy(*series_cols).orderBy(order_col)
    lagged = {}
    for i in range(1, n + 1):
        for c in cols:
            lagged[f"{c}_lag{i}"] = F.lag(c, i).over(w)
    return df.withColumns(lagged)


def fill_down(df: DataFrame, series_cols: list[str], order_col: str, cols: list[str]) -> DataFrame:
    """a null takes the last known value of its series; leading nulls stay.

    The window's partitions hold one row per period of a series.
    """
    w = Window.partitionBy(*series_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def ever_before(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    flag: Column,
    out_col: str,
) -> DataFrame:
    """1 if the flag was on in any strictly earlier period of the group, else 0.

    The rows are first collapsed to one per (group, period), so the window
    holds one row per period whatever the group's size.
    Returns (group_cols, order_col, out_col).
    """
    per = df.groupBy(*group_cols, order_col).agg(F.max(flag.cast("int")).alias("_f"))
    w = (
        Window.partitionBy(*group_cols)  # a null group value forms its own group
        .orderBy(order_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return per.select(
        *group_cols,
        order_col,
        F.coalesce(F.max("_f").over(w), F.lit(0)).cast("int").alias(out_col),
    )


def first_period_flag(
    df: DataFrame, facts: DataFrame, region_col: str, period_col: str, out_col: str
) -> DataFrame:
    """Flag the first period in which a region actually reported (K8).

    The minimum is taken over real reports (``facts``), one row per region,
    and joined back on the region.
    """
    first = facts.groupBy(region_col).agg(F.min(period_col).alias("_first"))
    return (
        df.join(first, on=region_col, how="left")
        .withColumn(out_col, F.coalesce(F.col(period_col) == F.col("_first"), F.lit(False)))
        .drop("_first")
    )
