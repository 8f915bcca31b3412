"""Yearly covariates, missing-data handling and the ``prepvar`` transform
(K2, K4, K7, M1, B9, B10).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_finite


def join_yearly(
    df: DataFrame,
    table: DataFrame,
    value_col: str,
    keys: dict[str, str],
    missing_flag: bool = True,
) -> DataFrame:
    """Left join one yearly covariate; ``keys`` maps df column -> table column.

    The ``<value>_missing`` flag is true when the value is null *or* the row
    is absent from the covariate table.
    """
    t = table.select(*[F.col(v).alias(k) for k, v in keys.items()], F.col(value_col))
    out = df.join(t, on=list(keys), how="left")
    if missing_flag:
        out = out.withColumn(f"{value_col}_missing", F.col(value_col).isNull())
    return out


def missing_report(df: DataFrame, value_col: str, by: list[str]) -> DataFrame:
    """Rows that lack ``value_col``, counted per ``by`` (the warning side output)."""
    return df.where(F.col(value_col).isNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows_dropped")
    )


def missing_flags_zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<c>_missing`` = c is null, then c := 0 where null."""
    flags = {f"{c}_missing": F.col(c).isNull() for c in cols}
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols}
    return df.withColumns(flags).withColumns(fills)


def column_checks(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: null count, NaN count and +-Inf count (one pass, unpivoted)."""
    cols = cols or df.columns
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    aggs = []
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__null"))
        if c in numeric:
            aggs.append(F.count_if(F.isnan(c)).alias(f"{c}__nan"))
            aggs.append(F.count_if(F.abs(F.col(c)) == float("inf")).alias(f"{c}__inf"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"{c}__nan"))
            aggs.append(F.lit(0).cast("long").alias(f"{c}__inf"))
    wide = df.agg(*aggs)
    stack = ", ".join(
        f"'{c}', `{c}__null`, `{c}__nan`, `{c}__inf`" for c in cols
    )
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) as (column_name, n_null, n_nan, n_inf)"
    )


# ---- prepvar ------------------------------------------------------------------
@dataclass
class PrepvarStats:
    """Fitted fill values of ``prepvar`` (store at fit time, reuse at forecast)."""

    na_fill: float | None
    zero_fill: float | None


def _prep_parts(x: Column, trans_fn: Callable[[Column], Column], zero_val):
    bad = ~is_finite(x)
    zero = (~bad) & (x == 0)
    regular = (~bad) if zero_val == "zero" else (~bad & ~zero)
    t = F.when(regular, trans_fn(x))
    return bad, zero, t


def prepvar_apply(
    x: Column,
    stats: PrepvarStats,
    trans_fn: Callable[[Column], Column] = lambda c: c,
    na_val="auto",
    zero_val="zero",
) -> Column:
    """Transform ``x`` and fill NA/Inf (and optionally zeros) from fitted stats.

    * regular values -> ``trans_fn(x)``
    * NA / NaN / Inf -> ``min - 6*sd`` of the transformed regular values
      ("auto") or the constant ``na_val``
    * zeros: kept as regular ("zero"), ``min - 3*sd`` ("auto") or a constant
    """
    bad, zero, t = _prep_parts(x, trans_fn, zero_val)
    na_v = F.lit(stats.na_fill).cast("double") if na_val == "auto" else F.lit(float(na_val))
    out = F.when(bad, na_v)
    if zero_val == "auto":
        out = out.when(zero, F.lit(stats.zero_fill).cast("double"))
    elif zero_val != "zero":
        out = out.when(zero, F.lit(float(zero_val)))
    return out.otherwise(t).cast("double")


def prepvar_fit_many(df: DataFrame, specs: dict) -> dict[str, PrepvarStats]:
    """Fit several ``prepvar`` transforms with ONE aggregate over ``df``.

    ``specs`` maps output name -> (x, trans_fn, zero_val).  The result is 2
    numbers per variable (the stored transformer, reused at forecast time).
    """
    aggs = []
    for name, (x, trans_fn, zero_val) in specs.items():
        _, _, t = _prep_parts(x, trans_fn, zero_val)
        aggs += [F.min(t).alias(f"{name}__mn"), F.stddev_samp(t).alias(f"{name}__sd")]
    row = df.agg(*aggs).first()
    out = {}
    for name in specs:
        mn, sd = row[f"{name}__mn"], row[f"{name}__sd"]
        if mn is None or sd is None:
            out[name] = PrepvarStats(None, None)
        else:
            out[name] = PrepvarStats(mn - 6 * sd, mn - 3 * sd)
    return out


def prepvar_columns(df: DataFrame, specs: dict, na_val="auto") -> dict[str, Column]:
    """Fit on ``df`` and return the transformed columns (one stats job)."""
    stats = prepvar_fit_many(df, specs)
    return {
        name: prepvar_apply(x, stats[name], trans_fn, na_val, zero_val)
        for name, (x, trans_fn, zero_val) in specs.items()
    }


def prepvar(
    df: DataFrame,
    x: Column,
    trans_fn: Callable[[Column], Column] = lambda c: c,
    na_val="auto",
    zero_val="zero",
    stats: PrepvarStats | None = None,
) -> Column:
    """Single-variable ``prepvar``; statistics fitted on ``df`` unless given."""
    if stats is None:
        stats = prepvar_fit_many(df, {"v": (x, trans_fn, zero_val)})["v"]
    return prepvar_apply(x, stats, trans_fn, na_val, zero_val)


def fit_prepvar(
    df: DataFrame, x: Column, trans_fn=lambda c: c, zero_val="zero"
) -> PrepvarStats:
    """Compute and return the fill values (a two-number driver result)."""
    _, _, t = _prep_parts(x, trans_fn, zero_val)
    row = df.select(t.alias("_t")).agg(
        F.min("_t").alias("mn"), F.stddev_samp("_t").alias("sd")
    ).first()
    mn, sd = row["mn"], row["sd"]
    if mn is None or sd is None:
        return PrepvarStats(None, None)
    return PrepvarStats(mn - 6 * sd, mn - 3 * sd)
