"""Registered impact, split and data-check queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.periods import period_idx, semester_of_period, year_of_period
from ..operators import covariates as cov
from ..operators import checks, impact, panel, spatial, splits
from ..sources import bindings as B
from . import network as NW
from . import nowcast as N
from . import oracle as O
from . import oracle_network as ON
from .registry import register
from .stages import stage

SPLIT_END_YEAR = 2030
SPLIT_END_MONTH = dt.date(2030, 11, 1)

IMPACT_SQL = O.with_(ON.events_ctes() + [ON.points_cte()], """
SELECT e.outbreak_thread_id, e.country_iso3c AS country, e.country_iso3c, e.disease, p.species_name AS taxa,
       CAST(coalesce(sum(p.cases), 0) AS BIGINT) AS total_cases,
       CAST(coalesce(sum(p.deaths), 0) AS BIGINT) AS total_deaths,
       CAST(coalesce(sum(p.killed_and_disposed), 0) AS BIGINT) AS total_killed_and_disposed,
       CAST(coalesce(sum(p.slaughtered_for_commercial_use), 0) AS BIGINT) AS total_slaughtered_for_commercial_use,
       min(p.outbreak_start_date) AS outbreak_start_date, max(p.outbreak_start_date) AS outbreak_end_date
FROM b9 p JOIN (SELECT * FROM b2 WHERE country_iso3c IS NOT NULL AND country_iso3c <> 'NA') e
  ON p.report_id = e.report_id
GROUP BY ALL""")


@register("impact_summary", IMPACT_SQL)
def impact_summary(spark, sf_dir):
    """Totals and first / last outbreak date per thread x taxa."""
    return impact.impact_summary(B.outbreak_events(spark, sf_dir), B.outbreak_points(spark, sf_dir))


@register("bounding_radius")
def bounding_radius(spark, sf_dir):
    """Radius (m) of the smallest circle around each thread x taxa's outbreaks."""
    ob = impact.impact_outbreaks(B.outbreak_events(spark, sf_dir), B.outbreak_points(spark, sf_dir))
    return spatial.bounding_radius(ob, impact.IMPACT_KEY)


def _nowcast_split(spark, sf_dir):
    reports = N.init_reports(spark, sf_dir)
    facts = reports.withColumn("period", period_idx())
    first_year = facts.agg(F.min("report_year")).first()[0]
    grid = panel.dense_grid(
        facts.select("disease", "disease_population", "taxa", "country_iso3c", "period"),
        ["disease", "disease_population", "taxa"], "country_iso3c", "period",
        first_year * 2, SPLIT_END_YEAR * 2 + 1,
    ).drop("_observed")
    s = splits.split_adjacent_pairs(grid, K.NOWCAST_SERIES, "period", 0.1)
    return s.select(*K.NOWCAST_SERIES, year_of_period("period").alias("report_year"),
                    semester_of_period("period").alias("report_semester"), "validation_set")


@register("split_adjacent_pairs")
def split_adjacent_pairs(spark, sf_dir):
    """Nowcast split lookup (10 % of semesters per series plus a neighbour), to 2030."""
    return _nowcast_split(spark, sf_dir)


@register("split_monthly")
def split_monthly(spark, sf_dir):
    """Network split lookup (20 % of months per country-disease), to 2030-11."""
    m = NW.monthly_panel(spark, sf_dir)
    start = m.agg(F.min("month")).first()[0]
    grid = panel.dense_grid(
        m.select("disease", "country_iso3c", "month"), ["disease"], "country_iso3c", "month",
        start, SPLIT_END_MONTH, step=F.expr("interval 1 month"),
    ).drop("_observed")
    return splits.split_sample(grid, ["country_iso3c", "disease"], "month", 0.2)


@register("split_attach")
def split_attach(spark, sf_dir):
    """S3: split membership attached to the rolled-up reports."""
    return splits.attach_split(N.init_reports(spark, sf_dir), _nowcast_split(spark, sf_dir), K.NOWCAST_KEY)


@register("training_rows")
def training_rows(spark, sf_dir):
    """Nowcast feature rows of the training set."""
    feats = stage(spark, sf_dir, "nowcast_features", lambda: N.nowcast_features(spark, sf_dir))
    return splits.training_rows(splits.attach_split(feats, _nowcast_split(spark, sf_dir), K.NOWCAST_KEY))


@register("split_share")
def split_share(spark, sf_dir):
    """S4 report: validation share and countries missing from training."""
    feats = N.init_reports(spark, sf_dir)
    return splits.split_share(splits.attach_split(feats, _nowcast_split(spark, sf_dir), K.NOWCAST_KEY))


@register("bootstrap_validation")
def bootstrap_validation(spark, sf_dir):
    """Bootstrap resample of the scored validation rows."""
    scored = N.scored_baseline(spark, sf_dir)
    val = splits.validation_rows(splits.attach_split(scored, _nowcast_split(spark, sf_dir), K.NOWCAST_KEY))
    return splits.bootstrap(val, K.NOWCAST_KEY, seed=42)


ROLL_COLS = K.NOWCAST_KEY + ["cases", "disease_status", "control_measures"]


@register(
    "data_checks",
    O.with_(O.rollup_ctes(), "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"CAST(0 AS BIGINT) AS n_nan, CAST(0 AS BIGINT) AS n_inf FROM rolled"
        for c in ROLL_COLS
    )),
)
def data_checks(spark, sf_dir):
    """Per column null / NaN / Inf counts of the rolled-up reports."""
    return cov.column_checks(N.rolled_reports(spark, sf_dir), ROLL_COLS)


@register(
    "incomplete_predictions",
    O.with_(ON.features_ctes(), "\nUNION ALL\n".join(
        f"SELECT disease, '{c}' AS column_name, count(*) AS n_rows FROM feats WHERE {c} IS NULL GROUP BY disease" for c in NW.INPUTS)),
)
def incomplete_predictions(spark, sf_dir):
    """Rows that get no prediction, by disease and the column that lacks a value."""
    return checks.null_report(NW.network_features(spark, sf_dir), NW.INPUTS, ["disease"])


@register("unassigned_rows")
def unassigned_rows(spark, sf_dir):
    """B9 + S3: report rows that the split does not cover, by country."""
    rows = splits.attach_split(N.init_reports(spark, sf_dir), _nowcast_split(spark, sf_dir), K.NOWCAST_KEY)
    return splits.unassigned_rows(rows).groupBy("country_iso3c").agg(F.count(F.lit(1)).alias("n_rows"))
