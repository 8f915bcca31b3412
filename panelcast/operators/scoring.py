"""Forecast scoring and evaluation.

All metrics are aggregates over small derived tables (confusion counts,
per-slice counts); the only full-data work is a single groupBy each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import direction, safe_div
from .ranks import value_ranks


def persistence_forecast(df: DataFrame) -> DataFrame:
    """Baseline: status = last period's status (null -> 0); cases = last
    period's cases where the predicted status is 1, else 0."""
    pred = F.coalesce(F.col("disease_status_lag1"), F.lit(0)).cast("int")
    return df.withColumns(
        {
            "disease_status_predicted": pred,
            "cases_predicted": F.when(pred == 1, F.col("cases_lag1").cast("double")).otherwise(
                F.lit(0.0)
            ),
        }
    )


def score_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Row scores: case error, direction of change (actual / predicted), matches."""
    ca, cp, cl = F.col("cases"), F.col("cases_predicted"), F.col("cases_lag1")
    sa, sp, sl = (
        F.col("disease_status"),
        F.col("disease_status_predicted"),
        F.col("disease_status_lag1"),
    )
    out = df.select(
        *key,
        sa.alias("disease_status_actual"),
        ca.cast("double").alias("cases_actual"),
        cl.cast("double").alias("cases_lag1"),
        sl.alias("disease_status_lag1"),
        sp.alias("disease_status_predicted"),
        cp.cast("double").alias("cases_predicted"),
        F.abs(ca - cp).cast("double").alias("cases_error"),
        direction(ca - cl, "increase", "decrease").alias("cases_dirchange_actual"),
        direction(cp - cl, "increase", "decrease").alias("cases_dirchange_predicted"),
        direction(sa - sl, "outbreak starts", "outbreak ends").alias(
            "disease_status_dirchange_actual"
        ),
        direction(sp - sl, "outbreak starts", "outbreak ends").alias(
            "disease_status_dirchange_predicted"
        ),
        (sa == sp).alias("disease_status_match"),
    )
    return out.withColumn(
        "cases_dirchange_match",
        F.col("cases_dirchange_actual") == F.col("cases_dirchange_predicted"),
    )


def confusion_matrix(
    df: DataFrame, truth: str, estimate: str, by: list[str] | None = None
) -> DataFrame:
    """Counts per (by..., truth, estimate); rows missing either label are dropped."""
    by = by or []
    return (
        df.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
        .groupBy(*by, F.col(truth).cast("string").alias("truth"),
                 F.col(estimate).cast("string").alias("estimate"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_metrics(cm: DataFrame, by: list[str]) -> DataFrame:
    """accuracy, kap (Cohen's kappa), sens, spec from a confusion table.

    Classes are the union of truth and estimate labels per group.  With two
    classes the first label (sorted) is the event; with more, sens/spec are
    macro averages over the classes.  Output is long: (by..., metric, estimate).
    """
    g = cm.groupBy(*by).agg(
        F.sum("n").alias("N"),
        F.sum(F.when(F.col("truth") == F.col("estimate"), F.col("n"))).alias("correct"),
    )
    rows = cm.groupBy(*by, F.col("truth").alias("k")).agg(F.sum("n").alias("r"))
    cols = cm.groupBy(*by, F.col("estimate").alias("k")).agg(F.sum("n").alias("c"))
    diag = cm.where(F.col("truth") == F.col("estimate")).select(
        *by, F.col("truth").alias("k"), F.col("n").alias("tp")
    )
    per = (
        rows.join(cols, on=by + ["k"], how="full")
        .join(diag, on=by + ["k"], how="left")
        .join(g, on=by, how="inner")
        .fillna(0, subset=["r", "c", "tp"])
    )
    per = per.withColumns(
        {
            "recall": safe_div(F.col("tp"), F.col("r")),
            "specificity": safe_div(
                F.col("N") - F.col("r") - F.col("c") + F.col("tp"), F.col("N") - F.col("r")
            ),
            "_rank": F.row_number().over(Window.partitionBy(*by).orderBy("k")),
            "_ncls": F.count(F.lit(1)).over(Window.partitionBy(*by)),
        }
    )
    summ = per.groupBy(*by).agg(
        F.first("N").alias("N"),
        F.first("correct").alias("correct"),
        F.sum(F.col("r") * F.col("c")).alias("rc"),
        F.first("_ncls").alias("ncls"),
        F.avg("recall").alias("macro_sens"),
        F.avg("specificity").alias("macro_spec"),
        F.max(F.when(F.col("_rank") == 1, F.col("recall"))).alias("bin_sens"),
        F.max(F.when(F.col("_rank") == 1, F.col("specificity"))).alias("bin_spec"),
    )
    po = F.coalesce(F.col("correct"), F.lit(0)) / F.col("N")
    pe = F.col("rc") / (F.col("N") * F.col("N"))
    metrics = summ.select(
        *by,
        po.cast("double").alias("accuracy"),
        safe_div(po - pe, 1 - pe).cast("double").alias("kap"),
        F.when(F.col("ncls") <= 2, F.col("bin_sens")).otherwise(F.col("macro_sens")).alias("sens"),
        F.when(F.col("ncls") <= 2, F.col("bin_spec")).otherwise(F.col("macro_spec")).alias("spec"),
    )
    return metrics.unpivot(by, ["accuracy", "kap", "sens", "spec"], "metric", "estimate")


def accuracy_by_slice(
    scored: DataFrame,
    slice_cols: list[str],
    model_col: str = "model",
    truth: str = "disease_status_dirchange_actual",
    estimate: str = "disease_status_dirchange_predicted",
    new_label: str = "outbreak starts",
) -> DataFrame:
    """Accuracy per (slice, value, model), overall and on true outbreak starts.

    All slices are stacked with one unpivot and aggregated by a single groupBy
    (instead of one job per slice value).
    """
    base = scored.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull()).select(
        model_col, truth, estimate, *[F.col(c).cast("string").alias(c) for c in slice_cols]
    )
    long = base.unpivot([model_col, truth, estimate], slice_cols, "slice", "slice_value")
    hit = (F.col(truth) == F.col(estimate)).cast("int")
    new = F.col(truth) == new_label
    agg = long.groupBy("slice", "slice_value", model_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hit).alias("n_correct"),
        F.sum(new.cast("int")).alias("n_new"),
        F.sum(F.when(new, hit)).alias("n_new_correct"),
    )
    acc = F.col("n_correct") / F.col("n")
    new_acc = safe_div(F.col("n_new_correct"), F.col("n_new"))
    pct = lambda c: F.concat(F.bround(c * 100, 0).cast("int").cast("string"), F.lit("%"))
    rank = F.dense_rank().over(Window.partitionBy("slice", model_col).orderBy(F.desc(acc)))
    return agg.select(
        "slice",
        "slice_value",
        model_col,
        rank.alias("accuracy_rank"),
        F.col("n").cast("long").alias("n"),
        F.col("n_new").cast("long").alias("n_new"),
        acc.cast("double").alias("accuracy"),
        new_acc.cast("double").alias("new_accuracy"),
        pct(acc).alias("accuracy_pct"),
        F.concat_ws(" / ", pct(acc), F.coalesce(pct(new_acc), F.lit("NaN"))).alias(
            "overall_new_pct"
        ),
    )


def regression_metrics(
    df: DataFrame, truth: str, estimate: str, by: list[str]
) -> DataFrame:
    """RMSE, R-squared (squared Pearson correlation, null without spread) and MAE per group."""
    d = df.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
    t, e = F.col(truth).cast("double"), F.col(estimate).cast("double")
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg((t - e) * (t - e))).alias("rmse"),
        safe_div(F.pow(F.covar_pop(t, e), 2), F.var_pop(t) * F.var_pop(e)).alias("rsq"),
        F.avg(F.abs(t - e)).alias("mae"),
    )


def wilson_interval(x, n, z: float = 1.959963984540054):
    """Wilson score interval (mean, lower, upper) for x successes in n."""
    x, n = F.col(x).cast("double"), F.col(n).cast("double")
    p = x / n
    denom = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / denom
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / denom
    return p, centre - half, centre + half


def calibration_bins(
    df: DataFrame,
    prob_col: str,
    outcome_col: str,
    n_bins: int,
    by: list[str] | None = None,
) -> DataFrame:
    """Equal-count bins of a predicted probability vs the observed rate.

    Bin edges are the exact order statistics at ranks ceil(i n / n_bins) of
    the probability per group, whatever the number of rows.  Equal
    probabilities are first counted together; ranks come from a range-sorted
    table of the distinct values with per-partition offsets, so no task holds
    a group.  Duplicate edges are collapsed; a value falls in the first bin
    whose upper edge is >= it.  Per bin: median prediction (the value at rank
    ceil(n / 2)), count, observed rate and Wilson interval.
    """
    groups = by or []
    by = by or ["_all"]
    d = df.where(F.col(prob_col).isNotNull() & F.col(outcome_col).isNotNull())
    d = d if groups else d.withColumn("_all", F.lit(0))
    values = d.groupBy(*by, F.col(prob_col).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(outcome_col).cast("int")).alias("_x"))
    ranked = value_ranks(values, by, "_p", "_n", "calibration_ranks")  # _lo: rows of the group below this value
    targets = F.array(*[F.greatest(F.lit(1), F.ceil(F.lit(i / n_bins) * F.col("_total"))) for i in range(1, n_bins)])
    holds = F.exists(targets, lambda t: (t > F.col("_lo")) & (t <= F.col("_lo") + F.col("_n")))
    edges = ranked.where(holds).groupBy(*by).agg(F.collect_set("_p").alias("_edges"))  # below n_bins per group
    joined = ranked.alias("r").join(
        edges.alias("e"), [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by], "left").select("r.*", "e._edges")
    # bin index = number of interior edges strictly below the value
    binned = joined.withColumn("bin", F.size(F.filter(F.coalesce("_edges", F.array()), lambda e: e < F.col("_p"))))
    bins = binned.groupBy(*by, "bin").agg(
        F.sum("_n").alias("n"), F.sum("_x").alias("x"), F.min("_lo").alias("_from"),
        F.min("_p").alias("pred_min"), F.max("_p").alias("pred_max"))
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in [*by, "bin"]]
    middle = F.col("a._from") + F.ceil(F.col("a.n") / 2)
    agg = bins.alias("a").join(binned.alias("b"), same).where(
        (F.col("b._lo") < middle) & (middle <= F.col("b._lo") + F.col("b._n"))
    ).select(*[F.col(f"a.{c}").alias(c) for c in [*by, "bin"]], "a.n", "a.x",
             F.col("b._p").alias("pred_median"), "a.pred_min", "a.pred_max")
    mean, lo, hi = wilson_interval("x", "n")
    return agg.select(
        *groups,
        "bin",
        F.col("n").cast("long").alias("n"),
        F.col("x").cast("long").alias("n_events"),
        "pred_median",
        "pred_min",
        "pred_max",
        mean.alias("actual_rate"),
        lo.alias("actual_low"),
        hi.alias("actual_high"),
    )
