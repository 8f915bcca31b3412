"""Registered nowcast-side queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import signif
from ..operators import covariates as cov
from ..operators import rollup, scoring
from ..session import checkpoint_dir
from ..sources import bindings as B
from ..sources.tables import LOOKUP_SCHEMAS, read_lookup_csv, write_csv, write_parquet
from . import nowcast as N
from . import oracle as O
from .registry import register

KEY_BIG = (
    "country_iso3c, CAST(report_year AS BIGINT) AS report_year, "
    "CAST(report_semester AS BIGINT) AS report_semester, disease, disease_population, taxa"
)


def sel(cols: list[str], bigint=(), dbl=()) -> str:
    out = []
    for c in cols:
        if c in bigint:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in dbl:
            out.append(f"round(CAST({c} AS DOUBLE), 4) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


# ---- P1 -----------------------------------------------------------------------------
@register(
    "report_rollup",
    O.with_(O.rollup_ctes(), f"SELECT {KEY_BIG}, cases, disease_status, control_measures FROM rolled"),
)
def report_rollup(spark, sf_dir):
    """Roll-up of raw report lines to one row per cell."""
    return N.rolled_reports(spark, sf_dir)


@register(
    "duplicate_keys",
    O.with_(
        O.rollup_ctes(),
        f"SELECT {O.KEY}, count(*) AS n FROM b1f GROUP BY {O.KEY} HAVING count(*) > 1"
        .replace("SELECT country_iso3c, report_year, report_semester",
                 "SELECT country_iso3c, CAST(report_year AS BIGINT) AS report_year, "
                 "CAST(report_semester AS BIGINT) AS report_semester"),
    ),
)
def duplicate_keys_q(spark, sf_dir):
    """Keys with several raw lines before the roll-up (after taxa merge)."""
    raw = B.six_month_reports(spark, sf_dir)
    norm = raw.withColumns(
        {
            "country_iso3c": F.upper("country_iso3c"),
            "taxa": rollup.normalise_taxa("taxa", merge=B.B1_TAXA_MERGE),
        }
    ).where(F.col("taxa").isin(B.B1_TAXA_LIST) & F.col("country_iso3c").isNotNull())
    return rollup.duplicate_keys(norm, K.NOWCAST_KEY)


# ---- P10 / P11 / P2 -------------------------------------------------------------------
@register(
    "name_clean_lookup",
    O.with_(O.lookup_ctes(), "SELECT disease, disease_recode, disease_recode_rare, n FROM lookup"),
)
def name_clean_lookup(spark, sf_dir):
    """P10 + C7 + E8: raw -> clean name, rare recode at the 15th percentile of counts."""
    return N.disease_lookup(N.rolled_reports(spark, sf_dir))


@register(
    "name_clean_free_text",
    O.with_(
        [],
        f"""SELECT p_name AS raw_name, {O.clean_sql('p_name')} AS clean_name, count(*) AS n
FROM part GROUP BY p_name
UNION ALL
SELECT o_orderpriority, {O.clean_sql('o_orderpriority')}, count(*) FROM orders GROUP BY o_orderpriority""",
    ).replace("WITH \n", ""),
)
def name_clean_free_text(spark, sf_dir):
    """C7 on free text (B10): part names and order priorities."""
    from ..functions.exprs import clean_name
    from ..sources.tables import read_table

    p = read_table(spark, sf_dir, "part", "p_name").groupBy(F.col("p_name").alias("raw_name")).agg(
        F.count(F.lit(1)).alias("n"))
    o = read_table(spark, sf_dir, "orders", "o_orderpriority").groupBy(
        F.col("o_orderpriority").alias("raw_name")).agg(F.count(F.lit(1)).alias("n"))
    both = p.unionByName(o)
    return both.select("raw_name", clean_name("raw_name").alias("clean_name"), "n")


@register(
    "rare_lump",
    O.with_(
        O.lookup_ctes(),
        f"""SELECT {KEY_BIG.replace('disease,', 'lk.disease_recode_rare AS disease,')}, count(*) AS n_cells,
       CAST(sum(r.cases) AS BIGINT) AS cases
FROM recoded r JOIN (SELECT DISTINCT disease_recode, disease_recode_rare FROM lookup) lk
  ON r.disease = lk.disease_recode
GROUP BY ALL""".replace("country_iso3c,", "r.country_iso3c,", 1),
    ),
)
def rare_lump(spark, sf_dir):
    """Rare diseases lumped into one label, cells re-aggregated."""
    rolled = N.rolled_reports(spark, sf_dir)
    lk = N.disease_lookup(rolled)
    rec = rollup.apply_rare_recode(rollup.recode_names(rolled, lk), lk)
    return rec.groupBy(*K.NOWCAST_KEY).agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum("cases").alias("cases"))


@register(
    "name_recode_join",
    O.with_(
        O.lookup_ctes(),
        f"SELECT {KEY_BIG}, disease_name_uncleaned, cases, disease_status, control_measures FROM recoded",
    ),
)
def name_recode_join(spark, sf_dir):
    """Cleaned disease names joined onto the roll-up."""
    return N.init_reports(spark, sf_dir)


@register(
    "lookup_csv_recode",
    O.with_(
        O.lookup_ctes(),
        f"SELECT {KEY_BIG}, disease_name_uncleaned, cases, disease_status, control_measures FROM recoded",
    ),
)
def lookup_csv_recode(spark, sf_dir):
    """A3 + A4 + A5 + P2: the name lookup as a gzipped CSV that a pipeline reads back with its types, reports as Parquet."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/panelcast-lookups/{uuid.uuid4().hex[:12]}"
    write_parquet(N.rolled_reports(spark, sf_dir), f"{folder}/rolled")
    rolled = spark.read.parquet(f"{folder}/rolled")
    lookup = N.disease_lookup(rolled).select("disease", "disease_recode")
    write_csv(lookup.coalesce(1), f"{folder}/disease_recode", gzip=True)  # a row per disease
    return rollup.recode_names(rolled, read_lookup_csv(spark, f"{folder}/disease_recode", LOOKUP_SCHEMAS["disease_recode"]))


# ---- R1 / F1 ---------------------------------------------------------------------------
@register(
    "dense_grid",
    O.with_(
        O.grid_ctes(),
        f"SELECT {KEY_BIG}, cases, disease_status, control_measures FROM dense",
    ),
)
def dense_grid(spark, sf_dir):
    """Every entity x country x semester 1995-2001, facts left-joined."""
    return N.lagged_panel(N.init_reports(spark, sf_dir), lags=0).select(
        *K.NOWCAST_KEY, "cases", "disease_status", "control_measures")


LAG_COLS = [f"{c}_lag{i}" for i in range(1, 4) for c in ("cases", "disease_status", "control_measures")]


@register(
    "panel_lags",
    O.with_(
        O.lag_ctes(3),
        f"SELECT {KEY_BIG}, cases, disease_status, control_measures, {', '.join(LAG_COLS)} FROM lagged",
    ),
)
def panel_lags(spark, sf_dir):
    """lags 1..3 of cases, status and control measures per series."""
    return N.lagged_panel(N.init_reports(spark, sf_dir), lags=3).select(
        *K.NOWCAST_KEY, "cases", "disease_status", "control_measures", *LAG_COLS)


@register(
    "daily_panel_lags",
    """SELECT user_id, event_type, day, cases, lag(cases, 1) OVER w AS cases_lag1,
       lag(cases, 2) OVER w AS cases_lag2,
       CAST(coalesce(max(CASE WHEN cases >= 3 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ever_busy_before,
       CAST(sum(cases) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cases_cumulative
FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS cases FROM events GROUP BY ALL) t
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY day)""",
)
def daily_panel_lags(spark, sf_dir):
    """F1-F3 on a different grain (B11): daily counts per (user, event type)."""
    from pyspark.sql import Window

    d = B.daily_panel(spark, sf_dir)
    w = Window.partitionBy("user_id", "event_type").orderBy("day")
    busy = (F.col("cases") >= 3).cast("int")
    return d.select(
        "user_id", "event_type", "day", "cases",
        F.lag("cases", 1).over(w).alias("cases_lag1"),
        F.lag("cases", 2).over(w).alias("cases_lag2"),
        F.coalesce(F.max(busy).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "ever_busy_before"),
        F.sum("cases").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cases_cumulative"),
    )


# ---- K0 / L8 / V1 ------------------------------------------------------------------------
BASE_COLS = [
    "disease_status", "cases", "cases_lag1", "disease_status_lag1",
    "disease_status_unreported", "disease_status_lag1_unreported",
    "disease_status_predicted", "cases_predicted",
]


@register(
    "persistence_forecast",
    O.with_(
        O.baseline_ctes(),
        f"SELECT {KEY_BIG}, "
        + sel(BASE_COLS, bigint=[c for c in BASE_COLS if c != "cases_predicted"], dbl=["cases_predicted"])
        + " FROM forecast",
    ),
)
def persistence_forecast(spark, sf_dir):
    """K0 + L8: baseline augment and the persistence forecast."""
    aug = N.baseline_augment(N.init_reports(spark, sf_dir))
    return scoring.persistence_forecast(aug).select(*K.NOWCAST_KEY, *BASE_COLS)


SCORE_COLS = [
    "disease_status_actual", "cases_actual", "cases_lag1", "disease_status_lag1",
    "disease_status_predicted", "cases_predicted", "cases_error",
    "cases_dirchange_actual", "cases_dirchange_predicted",
    "disease_status_dirchange_actual", "disease_status_dirchange_predicted",
    "disease_status_match", "cases_dirchange_match",
]


@register(
    "score_rows",
    O.with_(
        O.scored_ctes(),
        f"SELECT {KEY_BIG}, "
        + sel(
            SCORE_COLS[:-1],
            bigint=["disease_status_actual", "disease_status_lag1", "disease_status_predicted"],
            dbl=["cases_actual", "cases_lag1", "cases_predicted", "cases_error"],
        )
        + ", cases_dirchange_actual = cases_dirchange_predicted AS cases_dirchange_match FROM scored",
    ),
)
def score_rows(spark, sf_dir):
    """V1: row-level scores of the persistence forecast."""
    return N.scored_baseline(spark, sf_dir).select(*K.NOWCAST_KEY, *SCORE_COLS)


# ---- V2 / V3 / V4 / V5 / V6 -------------------------------------------------------------
def _cm_sql(truth: str, est: str, target: str, where: str = "") -> str:
    cond = f"{truth} IS NOT NULL AND {est} IS NOT NULL" + (f" AND {where}" if where else "")
    return (
        f"SELECT model, {O.q(target)} AS target, CAST({truth} AS VARCHAR) AS truth, "
        f"CAST({est} AS VARCHAR) AS estimate, count(*) AS n FROM scored WHERE {cond} GROUP BY ALL"
    )


CM_SQL = (
    _cm_sql("disease_status_actual", "disease_status_predicted", "disease_status")
    + "\nUNION ALL\n"
    + _cm_sql("disease_status_dirchange_actual", "disease_status_dirchange_predicted",
              "disease_status_dirchange")
    + "\nUNION ALL\n"
    + _cm_sql("disease_status_dirchange_actual", "disease_status_dirchange_predicted",
              "disease_status_dirchange_new",
              "disease_status_dirchange_actual = 'outbreak starts'")
)


def _confusions(spark, sf_dir):
    s = N.scored_baseline(spark, sf_dir)
    a = scoring.confusion_matrix(s, "disease_status_actual", "disease_status_predicted", ["model"])
    b = scoring.confusion_matrix(
        s, "disease_status_dirchange_actual", "disease_status_dirchange_predicted", ["model"])
    c = scoring.confusion_matrix(
        s.where(F.col("disease_status_dirchange_actual") == "outbreak starts"),
        "disease_status_dirchange_actual", "disease_status_dirchange_predicted", ["model"])
    return (
        a.withColumn("target", F.lit("disease_status"))
        .unionByName(b.withColumn("target", F.lit("disease_status_dirchange")))
        .unionByName(c.withColumn("target", F.lit("disease_status_dirchange_new")))
    )


@register("confusion_matrix", O.with_(O.scored_ctes() + [("cm", CM_SQL)], "SELECT * FROM cm"))
def confusion_matrix(spark, sf_dir):
    """V2: confusion counts for status, status change, and change on true starts."""
    return _confusions(spark, sf_dir).select("model", "target", "truth", "estimate", "n")


CLASS_METRICS_SQL = """
SELECT model, target, metric, round(estimate, 4) AS estimate FROM (
  SELECT model, target, accuracy, kap,
         CASE WHEN ncls <= 2 THEN bin_sens ELSE macro_sens END AS sens,
         CASE WHEN ncls <= 2 THEN bin_spec ELSE macro_spec END AS spec
  FROM (
    SELECT model, target, any_value(N) AS N, count(*) AS ncls,
           any_value(correct) / any_value(N) AS accuracy,
           CASE WHEN 1 - sum(r * c) / (any_value(N) * any_value(N)) = 0 THEN NULL ELSE
           (any_value(correct) / any_value(N) - sum(r * c) / (any_value(N) * any_value(N)))
             / (1 - sum(r * c) / (any_value(N) * any_value(N))) END AS kap,
           avg(recall) AS macro_sens, avg(specificity) AS macro_spec,
           max(CASE WHEN rk = 1 THEN recall END) AS bin_sens,
           max(CASE WHEN rk = 1 THEN specificity END) AS bin_spec
    FROM (
      SELECT k.*, g.N, g.correct,
             CASE WHEN r = 0 THEN NULL ELSE tp / r END AS recall,
             CASE WHEN g.N - r = 0 THEN NULL ELSE (g.N - r - c + tp) / (g.N - r) END AS specificity,
             row_number() OVER (PARTITION BY k.model, k.target ORDER BY k.k) AS rk
      FROM (
        SELECT model, target, k, coalesce(sum(r), 0) AS r, coalesce(sum(c), 0) AS c,
               coalesce(sum(tp), 0) AS tp
        FROM (
          SELECT model, target, truth AS k, n AS r, NULL AS c, CASE WHEN truth = estimate THEN n END AS tp FROM cm
          UNION ALL
          SELECT model, target, estimate AS k, NULL, n, NULL FROM cm
        ) u GROUP BY model, target, k
      ) k
      JOIN (SELECT model, target, sum(n) AS N,
                   coalesce(sum(CASE WHEN truth = estimate THEN n END), 0) AS correct
            FROM cm GROUP BY model, target) g USING (model, target)
    ) per GROUP BY model, target
  ) s
) t UNPIVOT INCLUDE NULLS (estimate FOR metric IN (accuracy, kap, sens, spec))"""


@register("class_metrics", O.with_(O.scored_ctes() + [("cm", CM_SQL)], CLASS_METRICS_SQL))
def class_metrics(spark, sf_dir):
    """V3 + V4: accuracy, kappa, sensitivity, specificity per model and target."""
    return scoring.class_metrics(_confusions(spark, sf_dir), ["model", "target"]).select(
        "model", "target", "metric", "estimate")


#: What the metrics say (fixed text of the evaluation report).
METRIC_TEXT = [
    ("accuracy", "share of rows predicted correctly"),
    ("kap", "accuracy beyond what chance would give"),
    ("sens", "share of actual positives predicted so"),
    ("spec", "share of actual negatives predicted so"),
    ("mcc", "correlation of prediction and truth"),
]
REPORT_SQL = f"""
SELECT d.metric, d.description, c.model, c.target,
  CASE WHEN c.estimate = 0 THEN 0.0 ELSE round_even(c.estimate / p, 0) * p END AS estimate
FROM (SELECT *, pow(10.0, floor(log10(abs(nullif(estimate, 0)))) - 1) AS p FROM (SELECT model, target, metric, estimate FROM ({CLASS_METRICS_SQL}) m) n) c
RIGHT JOIN (VALUES {', '.join(f"('{m}', '{t}')" for m, t in METRIC_TEXT)}) d(metric, description) ON c.metric = d.metric"""


@register("metric_report", O.with_(O.scored_ctes() + [("cm", CM_SQL)], REPORT_SQL))
def metric_report(spark, sf_dir):
    """A8 + C8 + D6: class metrics to two significant digits beside every described metric, computed or not."""
    text = spark.createDataFrame(METRIC_TEXT, "metric string, description string")
    found = scoring.class_metrics(_confusions(spark, sf_dir), ["model", "target"])
    return found.join(F.broadcast(text), "metric", "right").select(
        "metric", "description", "model", "target", signif("estimate", 2).alias("estimate"))


ACC_SQL = """
SELECT slice, slice_value, model,
       dense_rank() OVER (PARTITION BY slice, model ORDER BY accuracy DESC) AS accuracy_rank,
       n, n_new, round(accuracy, 4) AS accuracy,
       round(new_accuracy, 4) AS new_accuracy,
       CAST(CAST(round_even(accuracy * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS accuracy_pct,
       CAST(CAST(round_even(accuracy * 100, 0) AS INTEGER) AS VARCHAR) || '% / ' ||
         coalesce(CAST(CAST(round_even(new_accuracy * 100, 0) AS INTEGER) AS VARCHAR) || '%', 'NaN')
         AS overall_new_pct
FROM (
  SELECT slice, slice_value, model, count(*) AS n,
         sum(CASE WHEN t = e THEN 1 ELSE 0 END) / count(*) AS accuracy,
         sum(CASE WHEN t = 'outbreak starts' THEN 1 ELSE 0 END) AS n_new,
         CASE WHEN sum(CASE WHEN t = 'outbreak starts' THEN 1 ELSE 0 END) = 0 THEN NULL ELSE
           sum(CASE WHEN t = 'outbreak starts' AND t = e THEN 1 ELSE 0 END)
           / sum(CASE WHEN t = 'outbreak starts' THEN 1 ELSE 0 END) END AS new_accuracy
  FROM (
    SELECT model, disease_status_dirchange_actual AS t, disease_status_dirchange_predicted AS e,
           disease, taxa, continent
    FROM scored
    WHERE disease_status_dirchange_actual IS NOT NULL AND disease_status_dirchange_predicted IS NOT NULL
  ) b UNPIVOT INCLUDE NULLS (slice_value FOR slice IN (disease, taxa, continent))
  GROUP BY slice, slice_value, model
) a"""


@register("accuracy_by_slice", O.with_(O.scored_ctes(), ACC_SQL))
def accuracy_by_slice(spark, sf_dir):
    """V5: baseline accuracy of status change by disease / taxa / continent,
    overall and on true outbreak starts (flagship)."""
    return scoring.accuracy_by_slice(
        N.scored_baseline(spark, sf_dir), ["disease", "taxa", "continent"])


@register(
    "case_regression_metrics",
    O.with_(
        O.scored_ctes(),
        """SELECT model, count(*) AS n,
       round(sqrt(avg((cases_actual - cases_predicted) * (cases_actual - cases_predicted))), 4) AS rmse,
       round(pow(corr(cases_actual, cases_predicted), 2), 4) AS rsq,
       round(avg(abs(cases_actual - cases_predicted)), 4) AS mae
FROM scored WHERE cases_actual IS NOT NULL AND cases_predicted IS NOT NULL GROUP BY model""",
    ),
)
def case_regression_metrics(spark, sf_dir):
    """V6: RMSE, R-squared and MAE of predicted cases."""
    return scoring.regression_metrics(
        N.scored_baseline(spark, sf_dir), "cases_actual", "cases_predicted", ["model"])


# ---- V12 ---------------------------------------------------------------------------------
@register(
    "direction_shares",
    O.with_(
        O.scored_ctes(),
        """SELECT model, cases_dirchange_actual AS direction, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY model), 4) AS share
FROM scored WHERE cases_dirchange_actual IS NOT NULL GROUP BY model, cases_dirchange_actual""",
    ),
)
def direction_shares(spark, sf_dir):
    """Share of each direction-of-change class of cases."""
    from pyspark.sql import Window

    s = N.scored_baseline(spark, sf_dir).where(F.col("cases_dirchange_actual").isNotNull())
    g = s.groupBy("model", F.col("cases_dirchange_actual").alias("direction")).agg(
        F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("model")))


# ---- H2 + P2 (network family) ------------------------------------------------------------
@register(
    "name_lookup_union",
    O.with_(O.lookup_ctes(), f"""SELECT DISTINCT disease, disease_recode FROM (
  SELECT disease, disease_recode FROM lookup
  UNION ALL
  SELECT disease, CASE WHEN rn = 1 THEN clean ELSE clean || '_' || CAST(rn AS VARCHAR) END FROM (
    SELECT disease, clean, row_number() OVER (PARTITION BY clean ORDER BY n DESC, disease) AS rn FROM (
      SELECT disease, {O.clean_sql('disease')} AS clean, n FROM (
        SELECT o.o_orderpriority || '/' || c.c_mktsegment AS disease, count(*) AS n
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL) a) b) c) u"""),
)
def name_lookup_union(spark, sf_dir):
    """H2 + P2: the nowcast and network name lookups united and de-duplicated
    (the recode used when the model family is not known)."""
    from ..sources.tables import read_table

    now = N.disease_lookup(N.rolled_reports(spark, sf_dir)).select("disease", "disease_recode")
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    net_names = o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat_ws("/", "o_orderpriority", "c_mktsegment").alias("disease"))
    net = rollup.clean_name_lookup(net_names, "disease").select("disease", "disease_recode")
    return now.unionByName(net).distinct()
