"""Registered read-side queries (Y1-Y10, F7, G2, H3) over the prediction tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import links
from ..sources import bindings as B
from . import network as NW
from . import oracle as O
from . import oracle_network as ON
from . import reads
from .registry import register

SCALED = ON.SCALED
LINK = ON.LINK_VARS
IDS = ["country_iso3c", "disease", "month", "outbreak_start", "endemic", "outbreak_ongoing",
       "predicted_outbreak_probability"]
HIGHLIGHT = ["NATION_1", "NATION_2"]  # countries highlighted in the risk series (feature parameter)
PRIORITY = reads.PRIORITY
PRIORITY_PREFIX = "brand_number_1"  # binding's priority diseases for Y5


def _tables(spark, sf_dir):
    _, scaling, coefs = NW.network_model_tables(spark, sf_dir)
    preds = NW.network_predictions(spark, sf_dir)
    pred = preds.select("country_iso3c", "disease", "month", "predicted_outbreak_probability")
    return preds, scaling, coefs, pred


def _sd(num: str, den: str) -> str:
    return f"(CASE WHEN {den} = 0 THEN NULL ELSE {num} / {den} END)"


VI_SQL = f"""
, vi_long AS (
  SELECT {', '.join(IDS)}, variable, x FROM (
    SELECT {', '.join(IDS)}, {', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in SCALED)} FROM npred
  ) UNPIVOT INCLUDE NULLS (x FOR variable IN ({', '.join(SCALED)}))
  UNION ALL
  SELECT {', '.join(IDS)}, 'continent' || continent AS variable, 1.0 AS x FROM npred WHERE continent IS NOT NULL),
vi AS (
  SELECT l.*, c.coef, c.variable_clean, c.disease_clean, s.mean, s.sd,
         {_sd('(l.x - s.mean)', 's.sd')} AS x_standardized,
         {_sd('(l.x - s.mean)', 's.sd')} * c.coef AS variable_importance,
         {_sd('(l.x - s.mean)', 's.sd')} * c.coef > 0 AS pos,
         co.country
  FROM vi_long l
  LEFT JOIN coefs c ON l.disease = c.disease AND l.variable = c.variable
  LEFT JOIN scaling s ON l.variable = s.key
  LEFT JOIN countries co ON l.country_iso3c = co.country_iso3c)
"""


def _with(extra: str, final: str) -> str:
    base = O.with_(ON.model_ctes(), "SELECT 1")
    return base[: base.rindex("\nSELECT 1")] + extra + final


ROUND_VI = "round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability, " \
           "round(x, 4) AS x, round(coef, 4) AS coef, round(mean, 4) AS mean, round(sd, 4) AS sd, " \
           "round(x_standardized, 4) AS x_standardized, round(variable_importance, 4) AS variable_importance"


@register(
    "variable_importance",
    _with(VI_SQL, f"""SELECT country_iso3c, disease, month, outbreak_start, endemic, outbreak_ongoing,
       variable, variable_clean, disease_clean, pos, country, {ROUND_VI} FROM vi"""),
)
def variable_importance(spark, sf_dir):
    """Y2: standardised value x coefficient per model variable (all rows)."""
    preds, scaling, coefs, _ = _tables(spark, sf_dir)
    return A.variable_importance(preds, coefs, scaling, B.countries(spark, sf_dir), SCALED)


VO_IDS = ["country_iso3c", "country_origin_iso3c", "disease", "month", "outbreak_start", "endemic",
          "outbreak_ongoing", "predicted_outbreak_probability"]

VO_SQL = f"""
, vo_long AS (
  SELECT {', '.join(VO_IDS)}, variable, x FROM (
    SELECT country_iso3c, country_origin AS country_origin_iso3c, disease, month, outbreak_start, endemic,
           outbreak_ongoing, predicted_outbreak_probability,
           {', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in LINK)} FROM npred_o
  ) UNPIVOT INCLUDE NULLS (x FOR variable IN ({', '.join(LINK)}))),
vo_g AS (
  SELECT country_iso3c, disease, month, variable,
         CASE WHEN count(x) = count(*) THEN sum(x) END AS sum_x
  FROM vo_long GROUP BY country_iso3c, disease, month, variable),
vo0 AS (
  SELECT l.*, c.coef, s.mean, s.sd, g.sum_x
  FROM vo_long l
  JOIN vo_g g ON l.country_iso3c = g.country_iso3c AND l.disease = g.disease AND l.month = g.month
    AND l.variable = g.variable
  LEFT JOIN coefs c ON l.disease = c.disease AND l.variable = c.variable
  LEFT JOIN scaling s ON l.variable = s.key),
vo1 AS (
  SELECT *, {_sd('(sum_x - mean)', 'sd')} AS sum_x_standardized,
         {_sd('(sum_x - mean)', 'sd')} * coef AS overall_variable_importance FROM vo0),
vo AS (
  SELECT v.*, {_sd('overall_variable_importance', 'sum_x')} * x AS disagg_variable_importance,
         {_sd('overall_variable_importance', 'sum_x')} * x > 0 AS pos,
         c1.country, c2.country AS country_origin
  FROM vo1 v
  LEFT JOIN countries c1 ON v.country_iso3c = c1.country_iso3c
  LEFT JOIN countries c2 ON v.country_origin_iso3c = c2.country_iso3c)
"""

ROUND_VO = ", ".join(
    f"round({c}, 4) AS {c}"
    for c in ["predicted_outbreak_probability", "x", "coef", "mean", "sd", "sum_x", "sum_x_standardized",
              "overall_variable_importance", "disagg_variable_importance"]
)


def _cells(spark, sf_dir, **only):
    """Prediction cells with the importance of their link variables."""
    _, scaling, coefs = NW.network_model_tables(spark, sf_dir)
    nested = NW.network_predictions(spark, sf_dir, by_origin=True)
    return A.with_link_importance(nested, coefs, scaling, LINK, **only)


def _contributions(spark, sf_dir, **only):
    return A.with_contributions(_cells(spark, sf_dir, **only), LINK)


@register(
    "variable_importance_by_origin",
    _with(VO_SQL, f"""SELECT country_iso3c, country_origin_iso3c, disease, month, outbreak_start, endemic,
       outbreak_ongoing, variable, pos, country, country_origin, {ROUND_VO} FROM vo"""),
)
def variable_importance_by_origin(spark, sf_dir):
    """Link-variable importance distributed over origins."""
    return A.variable_importance_by_origin(_cells(spark, sf_dir), B.countries(spark, sf_dir), LINK)


RISK_SQL = VO_SQL + """
, risk AS (
  SELECT month, disease, country, country_iso3c, country_origin, country_origin_iso3c,
         predicted_outbreak_probability, sum(disagg_variable_importance) AS contribution_to_import_risk
  FROM vo WHERE contains(variable, 'from_outbreaks') AND disagg_variable_importance IS NOT NULL
  GROUP BY ALL)
"""


@register(
    "origin_import_risk",
    _with(RISK_SQL, """SELECT month, disease, country, country_iso3c, country_origin, country_origin_iso3c,
       round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability,
       round(contribution_to_import_risk, 4) AS contribution_to_import_risk FROM risk"""),
)
def origin_import_risk(spark, sf_dir):
    """Contribution of each origin country to the import risk."""
    return A.origin_import_risk(_contributions(spark, sf_dir), B.countries(spark, sf_dir))


@register(
    "origin_import_risk_current",
    _with(RISK_SQL, f"""SELECT month, disease, country, country_iso3c, country_origin, country_origin_iso3c,
       round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability,
       round(contribution_to_import_risk, 4) AS contribution_to_import_risk FROM risk
WHERE disease IN {O.in_list(PRIORITY)} AND month = CAST(date_trunc('month', {ON.AS_OF}) AS DATE)"""),
)
def origin_import_risk_current(spark, sf_dir):
    """Y3 + Y4 + G1 with the read's own defaults: priority diseases, current month, largest risk first."""
    return _reads(spark, sf_dir).origin_import_risk()


def _reads(spark, sf_dir):
    """Reads of the published formula model."""
    return reads.reads(spark, sf_dir, "formula", lambda: reads.formula_tables(spark, sf_dir))


CURRENT = f"disease IN {O.in_list(PRIORITY)} AND month = CAST(date_trunc('month', {ON.AS_OF}) AS DATE)"
ASKED = f"country_iso3c IN {O.in_list(HIGHLIGHT)}"


@register(
    "prediction_store",
    _with("", "SELECT country_iso3c, disease, month, round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability FROM npred"),
)
def prediction_store(spark, sf_dir):
    """K3: the published predictions, read back by name."""
    return _reads(spark, sf_dir).table("augment_predict").select("country_iso3c", "disease", "month", "predicted_outbreak_probability")


@register(
    "variable_importance_current",
    _with(VI_SQL, f"""SELECT country_iso3c, disease, month, outbreak_start, endemic, outbreak_ongoing,
       variable, variable_clean, disease_clean, pos, country, {ROUND_VI} FROM vi WHERE {CURRENT} AND {ASKED}"""),
)
def variable_importance_current(spark, sf_dir):
    """Y2 with arguments: two countries, priority diseases, current month, from the store."""
    return _reads(spark, sf_dir).variable_importance(HIGHLIGHT)


@register(
    "variable_importance_by_origin_current",
    _with(VO_SQL, f"""SELECT country_iso3c, country_origin_iso3c, disease, month, outbreak_start, endemic,
       outbreak_ongoing, variable, pos, country, country_origin, {ROUND_VO} FROM vo WHERE {CURRENT} AND {ASKED}"""),
)
def variable_importance_by_origin_current(spark, sf_dir):
    """Y3 with arguments: two countries, priority diseases, current month, from the store."""
    return _reads(spark, sf_dir).variable_importance_by_origin(HIGHLIGHT)


@register(
    "top_origins_current",
    _with(RISK_SQL, f"""SELECT * FROM (
  SELECT month, disease, country, country_iso3c, country_origin, country_origin_iso3c,
         round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability,
         round(contribution_to_import_risk, 4) AS contribution_to_import_risk,
         row_number() OVER (PARTITION BY country_iso3c, disease, month
                            ORDER BY contribution_to_import_risk DESC, country_origin_iso3c) AS rank
  FROM risk WHERE {CURRENT}) t WHERE rank <= 10"""),
)
def top_origins_current(spark, sf_dir):
    """Y8 with the read's own defaults, from the store."""
    return _reads(spark, sf_dir).top_origins()


@register(
    "top_origins",
    _with(RISK_SQL, """SELECT * FROM (
  SELECT month, disease, country, country_iso3c, country_origin, country_origin_iso3c,
         round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability,
         round(contribution_to_import_risk, 4) AS contribution_to_import_risk,
         row_number() OVER (PARTITION BY country_iso3c, disease, month
                            ORDER BY contribution_to_import_risk DESC, country_origin_iso3c) AS rank
  FROM risk) t WHERE rank <= 10"""),
)
def top_origins(spark, sf_dir):
    """Y8 + G2: ten largest origin contributions per destination-disease-month."""
    return A.top_origins(_contributions(spark, sf_dir), B.countries(spark, sf_dir), 10)


@register(
    "origin_share_lumped",
    _with(RISK_SQL, """SELECT country_iso3c, disease, month, origin_group, round(sum(share), 4) AS share,
       count(*) AS n_origins FROM (
  SELECT *, CASE WHEN share < 0.05 THEN 'other' ELSE country_origin_iso3c END AS origin_group FROM (
    SELECT *, CASE WHEN sum(contribution_to_import_risk) OVER (PARTITION BY country_iso3c, disease, month) = 0
                   THEN NULL ELSE contribution_to_import_risk /
                   sum(contribution_to_import_risk) OVER (PARTITION BY country_iso3c, disease, month) END AS share
    FROM risk WHERE contribution_to_import_risk > 0) a) b
GROUP BY country_iso3c, disease, month, origin_group"""),
)
def origin_share_lumped(spark, sf_dir):
    """Y9 + F7: shares of positive import risk, origins under 5 % lumped."""
    return A.origin_share_lumped(_contributions(spark, sf_dir), 0.05)


@register(
    "origin_list",
    O.with_(ON.monthly_ctes() + ON.links_ctes(), """SELECT disease, month, count(DISTINCT country_origin) AS n_origins,
       array_to_string(list_sort(list_distinct(list(country_origin))), ', ') AS origins
FROM presence GROUP BY disease, month"""),
)
def origin_list(spark, sf_dir):
    """Y10 + E3: number and sorted list of affected countries per disease-month."""
    return A.origin_list(links.presence_set(NW.monthly_panel(spark, sf_dir)))


@register(
    "origins_new",
    O.with_(ON.monthly_ctes() + ON.links_ctes(), """SELECT p.* FROM presence p
WHERE NOT EXISTS (SELECT 1 FROM presence q WHERE q.country_origin = p.country_origin AND q.disease = p.disease
                  AND CAST(q.month + INTERVAL 1 MONTH AS DATE) = p.month)"""),
)
def origins_new(spark, sf_dir):
    """H3: origins affected in a month but not in the month before (anti join)."""
    return A.origins_new(links.presence_set(NW.monthly_panel(spark, sf_dir)))


@register(
    "risk_series",
    _with("", f"""SELECT n.country_iso3c, c.country, n.continent, n.disease, n.month,
       round(100 * n.predicted_outbreak_probability, 4) AS probability_pct,
       n.country_iso3c IN {O.in_list(HIGHLIGHT)} AS highlighted
FROM npred n LEFT JOIN countries c ON n.country_iso3c = c.country_iso3c"""),
)
def risk_series(spark, sf_dir):
    """Probability series (percent) with highlighted countries."""
    preds, *_ = _tables(spark, sf_dir)
    names = B.countries(spark, sf_dir).select("country_iso3c", "country")
    return preds.join(names, on="country_iso3c", how="left").select(
        "country_iso3c", "country", "continent", "disease", "month",
        (F.col("predicted_outbreak_probability") * 100).alias("probability_pct"),
        F.col("country_iso3c").isin(HIGHLIGHT).alias("highlighted"),
    )


@register(
    "risk_change",
    _with("", """SELECT country_iso3c, disease, month,
       round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability,
       round(predicted_outbreak_probability - lag(predicted_outbreak_probability)
             OVER (PARTITION BY country_iso3c, disease ORDER BY month), 4) AS change
FROM pred"""),
)
def risk_change(spark, sf_dir):
    """Change of probability against the month before, per country-disease."""
    _, _, _, pred = _tables(spark, sf_dir)
    w = Window.partitionBy("country_iso3c", "disease").orderBy("month")
    p = F.col("predicted_outbreak_probability")
    return pred.select("country_iso3c", "disease", "month", p, (p - F.lag(p).over(w)).alias("change"))


@register(
    "priority_coefficients",
    _with("", f"""SELECT disease, variable, round(coef, 4) AS coef, variable_clean, disease_clean
FROM coefs WHERE starts_with(disease, {O.q(PRIORITY_PREFIX)})"""),
)
def priority_coefficients(spark, sf_dir):
    """Coefficients of the priority diseases."""
    _, _, coefs, _ = _tables(spark, sf_dir)
    return coefs.where(F.col("disease").startswith(PRIORITY_PREFIX))


STATUS_SQL = f"""
, outbreak_sem AS (
  SELECT disease, country_iso3c,
         year(month) + ((CASE WHEN month(month) < 7 THEN 1 ELSE 2 END) - 1) / 2.0 AS yr,
         CASE WHEN count(predicted_outbreak_probability) = count(*) THEN max(predicted_outbreak_probability) END
           AS predicted_semester_outbreak_probability,
         bool_or(endemic) AS endemic, bool_or(outbreak_start) AS outbreak_start,
         bool_or(outbreak_ongoing) AS outbreak_ongoing
  FROM npred GROUP BY ALL),
status AS (
  SELECT country_iso3c, disease, report_year + (report_semester - 1) / 2.0 AS yr, report_year, report_semester,
         bool_and(disease_status_unreported = 1) AS unrep,
         coalesce(sum(disease_status), 0) > 0 AS actual,
         coalesce(sum(cases_predicted), 0) > 0 AS pred
  FROM forecast GROUP BY ALL)
"""


STATUS_SELECT = f"""SELECT s.country_iso3c, s.disease, round(s.yr, 4) AS yr,
       CAST(s.report_year AS BIGINT) AS report_year, CAST(s.report_semester AS BIGINT) AS report_semester,
       CASE WHEN unrep THEN 'unreported' WHEN actual THEN 'present' ELSE 'absent' END AS actual_disease_status,
       CASE WHEN pred THEN 'present' ELSE 'absent' END AS predicted_disease_status,
       round(o.predicted_semester_outbreak_probability, 4) AS predicted_semester_outbreak_probability,
       o.endemic, o.outbreak_start, o.outbreak_ongoing, c.country,
       {ON.initcap_sql("replace(s.disease, '_', ' ')")} AS disease_clean
FROM status s
LEFT JOIN outbreak_sem o ON s.country_iso3c = o.country_iso3c AND s.disease = o.disease AND s.yr = o.yr
LEFT JOIN countries c ON s.country_iso3c = c.country_iso3c"""


@register("status_predict", _with(STATUS_SQL, STATUS_SELECT))
def status_predict(spark, sf_dir):
    """Reported / predicted status per semester with the max monthly probability."""
    preds, *_ = _tables(spark, sf_dir)
    return A.status_predict(preds, NW.nowcast_predictions(spark, sf_dir), B.countries(spark, sf_dir))


@register(
    "status_predict_current",
    _with(STATUS_SQL, f"{STATUS_SELECT} WHERE s.disease IN {O.in_list(PRIORITY)} AND s.{ASKED}"),
)
def status_predict_current(spark, sf_dir):
    """Y1 with arguments: two countries and the priority diseases, from the store."""
    return _reads(spark, sf_dir).status_predict(NW.nowcast_predictions(spark, sf_dir), HIGHLIGHT)
