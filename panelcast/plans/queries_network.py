"""Registered network-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import links, scoring, threads
from ..sources import bindings as B
from . import network as NW
from . import oracle as O
from . import oracle_network as ON
from .registry import register

FLAGS = ON.FLAGS
LINK = ON.LINK_VARS
LOGS = ["log_gdp_dollars", "log_human_population", "log_target_taxa_population", "log_veterinarians"]


@register(
    "thread_bounds",
    O.with_(ON.events_ctes(),
            "SELECT outbreak_thread_id, country_iso3c, disease, outbreak_start_month, outbreak_end_month FROM bounds"),
)
def thread_bounds(spark, sf_dir):
    """Per thread, start and end month (open threads stay open)."""
    return threads.thread_bounds(NW.events(spark, sf_dir), B.AS_OF)


MONTHLY_COLS = ["country_iso3c", "disease", "month", *FLAGS, "disease_in_single_country"]


@register("thread_month_panel", O.with_(ON.monthly_ctes(), f"SELECT {', '.join(MONTHLY_COLS)} FROM monthly"))
def thread_month_panel(spark, sf_dir):
    """P4 + P5 + P6 + P7: the country x disease x month outbreak panel."""
    return NW.monthly_panel(spark, sf_dir).select(*MONTHLY_COLS)


@register(
    "endemic_months",
    O.with_(ON.events_ctes() + ON.endemic_ctes(False), "SELECT country_iso3c, disease, month, endemic FROM endemic_all"),
)
def endemic_months(spark, sf_dir):
    """P5 + R7: months with reported or predicted cases, carried to the present."""
    return threads.endemic_months(NW.nowcast_predictions(spark, sf_dir), B.AS_OF)


@register(
    "single_country_screen",
    O.with_(ON.events_ctes(), """SELECT disease, count(DISTINCT country_iso3c) AS n_countries,
       count(DISTINCT country_iso3c) = 1 AS disease_in_single_country FROM ev GROUP BY disease"""),
)
def single_country_screen(spark, sf_dir):
    """P7 + E7: countries per disease and the single-country flag."""
    ev = threads.clean_events(NW.events(spark, sf_dir))
    return ev.groupBy("disease").agg(F.countDistinct("country_iso3c").alias("n_countries")).withColumn(
        "disease_in_single_country", F.col("n_countries") == 1)


@register("presence_set", O.with_(ON.monthly_ctes() + ON.links_ctes(), "SELECT * FROM presence"))
def presence_set(spark, sf_dir):
    """(origin, disease, month) with an outbreak start, continuation or endemic state."""
    return links.presence_set(NW.monthly_panel(spark, sf_dir))


@register("present_anywhere", O.with_(ON.monthly_ctes() + ON.links_ctes(), "SELECT * FROM anywhere"))
def present_anywhere(spark, sf_dir):
    """(disease, month) present in some country."""
    return links.present_anywhere(links.presence_set(NW.monthly_panel(spark, sf_dir)))


@register("primary_taxa", O.with_(ON.primary_taxa_ctes(), "SELECT disease, taxa, n_reports FROM primary_taxa"))
def primary_taxa(spark, sf_dir):
    """Disease -> taxa of its outbreak reports, with report counts."""
    return NW.primary_taxa(spark, sf_dir)


COV_COLS = ["country_iso3c", "continent", "disease", "month", *FLAGS, "disease_in_single_country"]


@register(
    "network_covariates",
    O.with_(ON.network_cov_ctes(),
            f"SELECT {', '.join(COV_COLS)}, year, {ON.dbl(LOGS)} FROM ncov"),
)
def network_covariates(spark, sf_dir):
    """Continent, log GDP / population / target-taxa population / vets (prepvar)."""
    from .stages import stage

    m = NW.monthly_panel(spark, sf_dir)
    cov = stage(spark, sf_dir, "network_covariates", lambda: NW.network_covariates(spark, sf_dir, m))
    return cov.select(*COV_COLS, "year", *LOGS)


@register(
    "import_pressure",
    O.with_(ON.features_ctes(), f"SELECT country_iso3c, disease, month, {ON.dbl(LINK)} FROM pressure"),
)
def import_pressure(spark, sf_dir):
    """K1: link values summed over the origins where the disease is present."""
    presence = links.presence_set(NW.monthly_panel(spark, sf_dir))
    static, yearly = NW.link_edges(spark, sf_dir)
    return links.import_pressure(presence, static, yearly)


FEAT_COLS = ["country_iso3c", "continent", "disease", "month", *FLAGS, "disease_present_anywhere"]


@register(
    "network_features",
    O.with_(ON.features_ctes(), f"SELECT {', '.join(FEAT_COLS)}, {ON.dbl(LOGS + LINK)} FROM feats"),
)
def network_features(spark, sf_dir):
    """K10-K13 + K1: the augmented network design (one row per target cell)."""
    return NW.network_features(spark, sf_dir).select(*FEAT_COLS, *LOGS, *LINK)


@register(
    "import_pressure_by_origin",
    O.with_(ON.features_ctes(),
            f"SELECT {', '.join(FEAT_COLS)}, country_origin, {ON.dbl(LOGS + LINK)} FROM feats_o"),
)
def import_pressure_by_origin(spark, sf_dir):
    """One row per linked present origin; a null-origin row where none."""
    return links.flat_origins(NW.network_features(spark, sf_dir, by_origin=True)).select(
        *FEAT_COLS, "country_origin", *LOGS, *LINK)


@register(
    "scaling_stats",
    O.with_(ON.model_ctes(), "SELECT key, round(mean, 4) AS mean, round(sd, 4) AS sd FROM scaling"),
)
def scaling_stats(spark, sf_dir):
    """L9 + L10: mean and sd of each predictor over the fitting rows."""
    return NW.scaling_stats(NW.fit_rows(NW.network_features(spark, sf_dir)))


Z = ON.SCALED


def _z_sql(alias="f"):
    return ", ".join(f"{ON.zsql(alias + '.' + v, v)} AS {v}" for v in Z)


@register(
    "standardise",
    O.with_(ON.model_ctes() + [("zrows", f"""
SELECT f.country_iso3c, f.continent, f.disease, f.month, f.outbreak_start, {_z_sql()} FROM fitrows f""")],
            f"SELECT country_iso3c, continent, disease, month, outbreak_start, {ON.dbl(Z)} FROM zrows"),
)
def standardise(spark, sf_dir):
    """Fitting rows standardised with the stored scaling table."""
    rows = NW.fit_rows(NW.network_features(spark, sf_dir))
    sc = NW.scaling_stats(rows)
    return NW.standardise_with(rows, sc).select(
        "country_iso3c", "continent", "disease", "month", "outbreak_start", *Z)


@register(
    "weight_compress",
    O.with_(ON.model_ctes() + [("zrows", f"""
SELECT f.country_iso3c, f.continent, f.disease, f.outbreak_start, {_z_sql()} FROM fitrows f""")],
            f"""SELECT country_iso3c, continent, disease, outbreak_start, {ON.dbl(Z)}, count(*) AS count
FROM zrows GROUP BY ALL"""),
)
def weight_compress(spark, sf_dir):
    """Identical design rows collapsed to one row with a count weight."""
    rows = NW.fit_rows(NW.network_features(spark, sf_dir))
    z = NW.standardise_with(rows, NW.scaling_stats(rows)).select(
        "country_iso3c", "continent", "disease", "outbreak_start", *Z)
    return z.groupBy(*z.columns).agg(F.count(F.lit(1)).alias("count"))


@register(
    "binding_coefficients",
    O.with_(ON.model_ctes(),
            "SELECT disease, variable, round(coef, 4) AS coef, variable_clean, disease_clean FROM coefs"),
)
def binding_coefficients(spark, sf_dir):
    """The long coefficient table (disease, variable, coef, labels)."""
    return NW.binding_coefficients(spark, sf_dir, NW.network_features(spark, sf_dir))


@register(
    "network_predict",
    O.with_(ON.model_ctes(),
            "SELECT country_iso3c, disease, month, round(predicted_outbreak_probability, 4) AS predicted_outbreak_probability FROM pred"),
)
def network_predict(spark, sf_dir):
    """Outbreak-start probability from stored scaling and coefficients."""
    feats, sc, co = NW.network_model_tables(spark, sf_dir)
    return NW.predict(feats, sc, co)


def _calib_sql(n_bins: int, by: list[str]) -> str:
    part = ", ".join(by)
    pb = f"PARTITION BY {part}" if by else ""
    gb = (part + ", ") if by else ""
    sel_by = (part + ", ") if by else ""
    edges = ", ".join(
        f"max(CASE WHEN rn = greatest(1, CAST(ceil({i}/{n_bins} * n) AS BIGINT)) THEN p END) AS e{i}"
        for i in range(1, n_bins)
    )
    bin_expr = " + ".join(
        f"(CASE WHEN p > e{i} AND e{i} IS DISTINCT FROM {('e' + str(i - 1)) if i > 1 else 'NULL'} THEN 1 ELSE 0 END)"
        for i in range(1, n_bins)
    )
    return f"""
WITH cal AS (
  SELECT {sel_by} predicted_outbreak_probability AS p, outbreak_start AS y,
         row_number() OVER ({pb} ORDER BY predicted_outbreak_probability) AS rn,
         count(*) OVER ({pb}) AS n
  FROM npred WHERE predicted_outbreak_probability IS NOT NULL AND outbreak_start IS NOT NULL),
edges AS (SELECT {gb} {edges} FROM cal {('GROUP BY ' + part) if by else ''}),
binned AS (SELECT c.*, {bin_expr} AS bin FROM cal c {('JOIN edges e USING (' + part + ')') if by else ', edges e'}),
agg AS (
  SELECT {sel_by} bin, count(*) AS n, CAST(sum(CAST(y AS INTEGER)) AS BIGINT) AS n_events,
         quantile_disc(p, 0.5) AS pred_median, min(p) AS pred_min, max(p) AS pred_max
  FROM binned GROUP BY {gb} bin)
SELECT {sel_by} CAST(bin AS BIGINT) AS bin, n, n_events, round(pred_median, 4) AS pred_median,
       round(pred_min, 4) AS pred_min, round(pred_max, 4) AS pred_max,
       round(n_events / n, 4) AS actual_rate,
       round(((n_events / n) + 1.959963984540054 ** 2 / (2 * n)) / (1 + 1.959963984540054 ** 2 / n)
         - 1.959963984540054 * sqrt((n_events / n) * (1 - n_events / n) / n + 1.959963984540054 ** 2 / (4 * n * n))
           / (1 + 1.959963984540054 ** 2 / n), 4) AS actual_low,
       round(((n_events / n) + 1.959963984540054 ** 2 / (2 * n)) / (1 + 1.959963984540054 ** 2 / n)
         + 1.959963984540054 * sqrt((n_events / n) * (1 - n_events / n) / n + 1.959963984540054 ** 2 / (4 * n * n))
           / (1 + 1.959963984540054 ** 2 / n), 4) AS actual_high
FROM agg"""


def _calib_oracle(n_bins, by):
    inner = _calib_sql(n_bins, by)
    base = O.with_(ON.model_ctes(), "SELECT 1")
    ctes = base[len("WITH "):base.rindex("\nSELECT 1")]
    return "WITH " + ctes + ",\n" + inner.strip()[len("WITH "):]


@register("calibration_bins", _calib_oracle(30, []))
def calibration_bins(spark, sf_dir):
    """V7: 30 equal-count bins of predicted probability vs observed starts."""
    preds = NW.network_predictions(spark, sf_dir)
    return scoring.calibration_bins(preds, "predicted_outbreak_probability", "outbreak_start", 30)


@register("calibration_bins_by_disease", _calib_oracle(3, ["disease"]))
def calibration_bins_by_disease(spark, sf_dir):
    """V7: 3 equal-count bins per disease."""
    preds = NW.network_predictions(spark, sf_dir)
    return scoring.calibration_bins(
        preds, "predicted_outbreak_probability", "outbreak_start", 3, ["disease"])
