"""Network pipeline: outbreak events -> monthly panel -> covariates and
import pressure -> scaled features -> outbreak-start probability.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import all_not_null, safe_log10, title_from_snake
from ..operators import covariates as cov
from ..operators import links, panel, threads
from ..operators.rollup import normalise_taxa
from ..session import write_stage
from ..sources import bindings as B
from . import nowcast as N
from .stages import stage

SCALED = [v for v in B.PREDICTOR_VARS if v != "continent"]
#: What a prediction needs: a row without one of them gets none.
INPUTS = ["continent", *SCALED]
INTERCEPT = -3.0  # B8: fixed intercept of the binding's logistic model
FLAG_COLS = [
    "outbreak_start", "outbreak_subsequent_month", "outbreak_ongoing",
    "outbreak_start_while_ongoing_or_endemic", "endemic", "disease_country_combo_unreported",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.outbreak_events(spark, sf_dir)


def nowcast_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 (nowcast side): persistence forecast over the B1 panel."""
    from ..operators.scoring import persistence_forecast

    return N.forecast_baseline(spark, sf_dir)


def thread_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct thread spans of every (country, disease) (a stage): the events are scanned once for the panel."""
    return stage(spark, sf_dir, "network_thread_spans", lambda: threads.thread_spans(events(spark, sf_dir), B.AS_OF))


def endemic(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """P5 restricted to the (country, disease) pairs that have events.

    The restriction is applied to the rolled-up reports *before* the panel
    is densified and lagged: a kept pair's series are whole, and entities
    seen only by other pairs would only add unreported cells (never cases
    > 0), so the endemic months are the same as when filtering afterwards,
    at a fraction of the work.
    """
    from ..operators.scoring import persistence_forecast

    pairs = pairs.select("country_iso3c", "disease").distinct()
    reports = N.init_reports(spark, sf_dir).join(
        pairs, on=["country_iso3c", "disease"], how="left_semi")
    forecast = persistence_forecast(N.baseline_augment(reports))
    return threads.endemic_months(forecast, B.AS_OF)


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country x disease x month outbreak panel."""
    def build():
        spans = thread_spans(spark, sf_dir)
        return threads.thread_month_panel(
            None, B.GRID_START, B.AS_OF, endemic=endemic(spark, sf_dir, spans), spans=spans)

    return stage(spark, sf_dir, "network_monthly", build)


def primary_taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disease -> taxa seen in its outbreak reports, with report counts."""
    pts = B.outbreak_points(spark, sf_dir).select(
        "report_id", normalise_taxa("species_name", merge=B.B1_TAXA_MERGE).alias("taxa")
    ).distinct()
    ev = threads.clean_events(events(spark, sf_dir)).select("report_id", "disease")
    return pts.join(ev, on="report_id", how="inner").groupBy("disease", "taxa").agg(
        F.count(F.lit(1)).alias("n_reports"))


def network_covariates(spark: SparkSession, sf_dir: str, monthly: DataFrame) -> DataFrame:
    """Continent, GDP, human population, target-taxa population, vets."""
    df = monthly.withColumn("year", F.year("month"))
    df = N.with_continent(df, B.countries(spark, sf_dir))
    yr = {"country_iso3c": "country_iso3c", "year": "year"}
    df = cov.join_yearly(df, B.gdp(spark, sf_dir), "gdp_dollars", yr, missing_flag=False)
    df = cov.join_yearly(df, B.human_population(spark, sf_dir), "human_population", yr,
                         missing_flag=False)
    target = (
        B.taxa_population(spark, sf_dir)
        .join(primary_taxa(spark, sf_dir).select("disease", "taxa"), on="taxa", how="inner")
        .groupBy("country_iso3c", "year", "disease")
        .agg(F.sum("population").alias("target_taxa_population"))
    )
    df = df.join(target, on=["country_iso3c", "year", "disease"], how="left")
    df = cov.join_yearly(df, B.vets(spark, sf_dir), "veterinarian_count", yr, missing_flag=False)
    df = write_stage(df, "network_covariates_base")
    logs = cov.prepvar_columns(
        df,
        {
            "log_gdp_dollars": (F.col("gdp_dollars"), safe_log10, "zero"),
            "log_human_population": (F.col("human_population"), safe_log10, "zero"),
            "log_target_taxa_population": (F.col("target_taxa_population") + 1, safe_log10, "zero"),
            "log_veterinarians": (F.col("veterinarian_count") + 1, safe_log10, "zero"),
        },
    )
    return df.withColumns(logs).drop("gdp_dollars", "human_population", "target_taxa_population", "veterinarian_count")


def link_edges(spark: SparkSession, sf_dir: str):
    """Static and yearly link edges.

    In the bindings, borders / migration and trade / livestock each come
    from one aggregate, so each edge table is built from its single source
    (``links.static_edges`` / ``links.yearly_edges`` full-join separate
    tables when they come from different sources).
    """
    st = B.static_links(spark, sf_dir)
    static = st.select(
        "country_origin", "country_destination",
        (F.upper("shared_border") == "TRUE").cast("double").alias("shared_borders_from_outbreaks"),
        F.col("n_migratory_wildlife").cast("double").alias("n_migratory_wildlife_from_outbreaks"),
    )
    yl = stage(spark, sf_dir, "yearly_links", lambda: B.yearly_links(spark, sf_dir))  # summed features and origins share it
    yearly = yl.select(
        "country_origin", "country_destination", "year",
        F.col("ots_trade_dollars").cast("double").alias("ots_trade_dollars_from_outbreaks"),
        F.col("fao_livestock_heads").cast("double").alias("fao_livestock_heads_from_outbreaks"),
    )
    return static, yearly


BASE_COLS = [
    "country_iso3c", "continent", "disease", "month",
    "log_gdp_dollars", "log_human_population", "log_target_taxa_population", "log_veterinarians",
    *FLAG_COLS,
]


def network_features(spark: SparkSession, sf_dir: str, by_origin: bool = False) -> DataFrame:
    """K10-K13 (+K1, or K1b as an array of origins): the augmented network design table (a stage)."""
    name = "network_features_by_origin" if by_origin else "network_features"
    return stage(spark, sf_dir, name, lambda: _network_features(spark, sf_dir, by_origin))


def _network_features(spark: SparkSession, sf_dir: str, by_origin: bool) -> DataFrame:
    monthly = monthly_panel(spark, sf_dir)
    covs = stage(spark, sf_dir, "network_covariates",
                 lambda: network_covariates(spark, sf_dir, monthly)).select(*BASE_COLS)
    presence = links.presence_set(monthly)
    static, yearly = link_edges(spark, sf_dir)
    if by_origin:
        edges = links.merged_edges(static, yearly, B.GRID_START.year, B.AS_OF.year)
        out = links.with_origins(covs, links.import_origins(presence, edges))
    else:
        out = links.with_import_pressure(covs, links.import_pressure(presence, static, yearly))
    out = out.join(links.present_anywhere(presence), on=["disease", "month"], how="left")
    return out.withColumn(
        "disease_present_anywhere", F.coalesce(F.col("disease_present_anywhere"), F.lit(False))
    )


# ---- scaling, coefficients, prediction (L10, L11, L12, L15, B8) --------------------------
def fit_rows(features: DataFrame) -> DataFrame:
    """Complete rows, not endemic, not a subsequent month."""
    return features.dropna().where(~F.col("endemic") & ~F.col("outbreak_subsequent_month"))


def scaling_stats(rows: DataFrame, variables=SCALED) -> DataFrame:
    """(key, mean, sd) per predictor in one aggregate, unpivoted."""
    aggs = []
    for v in variables:
        x = F.col(v).cast("double")
        aggs += [F.avg(x).alias(f"{v}__mean"), F.stddev_samp(x).alias(f"{v}__sd")]
    wide = rows.agg(*aggs)
    stack = ", ".join(f"'{v}', `{v}__mean`, `{v}__sd`" for v in variables)
    return wide.selectExpr(f"stack({len(variables)}, {stack}) as (key, mean, sd)")


@dataclass
class Scaling:
    """Fitted standardisation (bounded by the number of predictors)."""

    mean: dict
    sd: dict

    @classmethod
    def from_table(cls, table: DataFrame) -> "Scaling":
        rows = table.collect()
        return cls({r["key"]: r["mean"] for r in rows}, {r["key"]: r["sd"] for r in rows})

    def columns(self, variables=SCALED) -> dict:
        # a constant predictor (sd 0 or undefined) carries no information:
        # it standardises to 0 (null values stay null)
        out = {}
        for v in variables:
            x = F.col(v).cast("double")
            sd = self.sd[v]
            if sd is None or sd == 0:
                out[v] = F.when(x.isNotNull(), F.lit(0.0))
            else:
                out[v] = (x - F.lit(self.mean[v])) / F.lit(sd)
        return out


def standardise_with(df: DataFrame, scaling_table: DataFrame, variables=SCALED) -> DataFrame:
    """(x - mean) / sd with the stored scaling values.

    The scaling table is a fitted parameter set (one row per predictor), so
    it is read once and enters the projection as literals.
    """
    sc = scaling_table if isinstance(scaling_table, Scaling) else Scaling.from_table(scaling_table)
    missing = [v for v in variables if v not in sc.mean]
    if missing:
        raise ValueError(f"scaling values missing for {missing}")
    return df.withColumns(sc.columns(variables))


def binding_coefficients(spark: SparkSession, sf_dir: str, diseases: DataFrame) -> DataFrame:
    """coef = ((ascii(disease) + length(variable)) % 7 - 3) / 10 for every
    disease x model variable (numeric predictors and continent levels)."""
    levels = B.countries(spark, sf_dir).where("continent IS NOT NULL").select(
        F.concat(F.lit("continent"), "continent").alias("level"))
    names = F.concat(F.array(*[F.lit(n) for n in SCALED]), panel.distinct_values(levels, "level"))
    d = diseases.select("disease").distinct()
    rows = d.withColumn("variable", F.explode(names))
    coef = ((F.ascii("disease") + F.length("variable")) % 7 - 3) / 10.0
    return rows.select(
        "disease",
        "variable",
        coef.cast("double").alias("coef"),
        F.regexp_replace(F.regexp_replace("variable", "_from_outbreaks$", ""), "_", " ").alias(
            "variable_clean"),
        title_from_snake(F.regexp_replace("disease", "/", "_")).alias("disease_clean"),
    )


def predict(features: DataFrame, scaling_table: DataFrame, coefficients: DataFrame,
            intercept: float = INTERCEPT) -> DataFrame:
    """logistic(intercept + sum_v coef[d, v] * z_v + coef[d, continent]).

    Coefficients are pivoted to one row per disease (explicit variable list)
    and joined on the disease; the continent slope joins on (disease,
    continent).  Incomplete rows get a null probability.
    """
    z = standardise_with(
        features.select("country_iso3c", "continent", "disease", "month", *SCALED),
        scaling_table,
    )
    wide = (
        coefficients.where(F.col("variable").isin(SCALED))
        .groupBy("disease")
        .pivot("variable", SCALED)
        .agg(F.first("coef"))
        .select("disease", *[F.col(v).alias(f"_c_{v}") for v in SCALED])
    )
    cont = coefficients.where(F.col("variable").startswith("continent")).select(
        "disease",
        F.expr("substring(variable, 10)").alias("continent"),
        F.col("coef").alias("_c_continent"),
    )
    j = z.join(wide, on="disease", how="left").join(cont, on=["disease", "continent"], how="left")
    eta = F.lit(intercept) + F.col("_c_continent")
    for v in SCALED:
        eta = eta + F.col(f"_c_{v}") * F.col(v)
    complete = all_not_null(INPUTS)
    # nine digits: the sum's last bits depend on the engine and the layout, and would split equal values
    prob = F.when(complete, F.round(1.0 / (1.0 + F.exp(-eta)), 9))
    return j.select("country_iso3c", "disease", "month", prob.alias("predicted_outbreak_probability"))


def network_predictions(spark: SparkSession, sf_dir: str, by_origin: bool = False) -> DataFrame:
    """B7 (network side): features + predicted probability, per origin if asked (stages)."""

    def build():
        feats, scaling, coefs = network_model_tables(spark, sf_dir)
        pred = predict(feats, scaling, coefs)
        key = ["country_iso3c", "disease", "month"]
        base = network_features(spark, sf_dir, by_origin=by_origin)
        return base.join(pred, on=key, how="left")

    name = "network_predictions_by_origin" if by_origin else "network_predictions"
    return stage(spark, sf_dir, name, build)


def network_model_tables(spark: SparkSession, sf_dir: str):
    feats = network_features(spark, sf_dir)
    return feats, scaling_stats(fit_rows(feats)), binding_coefficients(spark, sf_dir, feats)

