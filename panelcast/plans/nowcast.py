"""Nowcast pipeline: reports -> roll-up -> dense panel -> lags -> features
-> forecast -> scores.

Every function returns a lazy DataFrame; the whole chain is one Catalyst
plan.  Real shuffles: the roll-up groupBy, the grid/facts join, the lag
window (one series per partition key), the "ever" windows and the neighbour
groupBy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import control_flag_columns, status_to_int, unreported_marker
from ..functions.periods import period_idx, semester_of_period, year_of_period
from ..operators import covariates as cov
from ..operators import panel, rollup, scoring
from ..operators.checks import TableSchema, checked_stage
from ..operators.preparation import Prepvar
from ..sources import bindings as B
from .stages import stage

SERIES = K.NOWCAST_SERIES
KEY = K.NOWCAST_KEY


def rolled_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over the B1 binding (binding's own taxa list / merge)."""
    return rollup.rollup_reports(
        B.six_month_reports(spark, sf_dir),
        taxa_list=B.B1_TAXA_LIST,
        taxa_drop=B.B1_TAXA_DROP,
        taxa_merge=B.B1_TAXA_MERGE,
    )


def disease_lookup(rolled: DataFrame) -> DataFrame:
    """P10: name lookup from roll-up cell counts per raw disease name."""
    return rollup.clean_name_lookup(rolled, "disease")


def init_reports(spark: SparkSession, sf_dir: str, clean_names: bool = True) -> DataFrame:
    """P1 + P2: rolled-up reports with cleaned disease names (a stage)."""
    if not clean_names:
        return rolled_reports(spark, sf_dir)

    def build():
        # the roll-up feeds the lookup (and its percentile) and the recode:
        # written once so it is computed once
        rolled = checked_stage(rolled_reports(spark, sf_dir), REPORT_SCHEMA, "nowcast_rolled")
        return rollup.recode_names(rolled, disease_lookup(rolled))

    return stage(spark, sf_dir, "nowcast_reports", build)


def panel_lagged(spark: SparkSession, sf_dir: str, lags: int = 3) -> DataFrame:
    """The lagged dense panel over the cleaned reports (a stage)."""
    return stage(spark, sf_dir, f"nowcast_lagged{lags}",
                 lambda: lagged_panel(init_reports(spark, sf_dir), lags=lags))


def lagged_panel(
    reports: DataFrame,
    lags: int = 3,
    first_year: int = B.FIRST_YEAR,
    last_year: int = B.AS_OF.year,
) -> DataFrame:
    """R1 + F1: dense entity x country x semester grid with lags.

    Unreported cells get status "unreported"; a real cell whose statuses
    could not be resolved keeps a null status.
    """
    facts = reports.drop("disease_name_uncleaned").withColumn("period", period_idx()).drop(
        "report_year", "report_semester"
    )
    grid = panel.dense_grid(
        facts,
        entity_cols=["disease", "disease_population", "taxa"],
        region_col="country_iso3c",
        period_col="period",
        period_start=first_year * 2,
        period_end=last_year * 2 + 1,
    )
    grid = grid.withColumn(
        "disease_status",
        F.when(~F.col("_observed"), F.lit(K.STATUS_UNREPORTED)).otherwise(F.col("disease_status")),
    ).drop("_observed")
    lagged = panel.panel_lag(
        grid, SERIES, "period", ["cases", "disease_status", "control_measures"], lags
    )
    return lagged.withColumns(
        {"report_year": year_of_period("period"), "report_semester": semester_of_period("period")}
    )


def status_columns_to_int(df: DataFrame, cols: list[str]) -> DataFrame:
    """K5: `<c>_unreported` markers, then present -> 1, absent/unreported -> 0."""
    df = df.withColumns({f"{c}_unreported": unreported_marker(c) for c in cols})
    return df.withColumns({c: status_to_int(c) for c in cols})


def baseline_augment(reports: DataFrame) -> DataFrame:
    """K0: lag 1, status recode with unreported markers."""
    lagged = lagged_panel(reports, lags=1)
    out = lagged.select(
        *KEY, "period", "disease_status", "cases", "cases_lag1", "disease_status_lag1"
    )
    return status_columns_to_int(out, ["disease_status", "disease_status_lag1"])


def with_continent(df: DataFrame, countries: DataFrame) -> DataFrame:
    return df.join(countries.select("country_iso3c", "continent"), on="country_iso3c", how="left")


def forecast_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K0 + L8: the persistence forecast table (a stage; B7 nowcast side)."""
    return stage(spark, sf_dir, "nowcast_forecast",
                 lambda: scoring.persistence_forecast(baseline_augment(init_reports(spark, sf_dir))))


def scored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 + V1 over the full panel, with continent for slicing."""
    scored = scoring.score_rows(forecast_baseline(spark, sf_dir), KEY)
    return with_continent(scored, B.countries(spark, sf_dir)).withColumn(
        "model", F.lit("baseline")
    )


# ---- full feature set (K1-K9) ---------------------------------------------------
def control_flags(df: DataFrame, lags: int = 3) -> DataFrame:
    """C14: flags from the union text of the lagged control measures."""
    joined = F.concat_ws(
        K.CONTROL_SEPARATOR, *[F.col(f"control_measures_lag{i}") for i in range(1, lags + 1)]
    )
    return df.withColumn("_cm_lag", joined).withColumns(control_flag_columns("_cm_lag")).drop(
        "_cm_lag", *[f"control_measures_lag{i}" for i in range(1, lags + 1)]
    )


def neighbour_lag_sum(lagged: DataFrame, borders: DataFrame, lags: int = 3) -> DataFrame:
    """Per cell, sum of lag 1..n cases over bordering countries.

    Each row's lags are pre-summed (null only if all are null), then the
    border edges are joined and one groupBy sums per destination cell;
    null when the country has no border or no border value.
    Returns KEY + cases_lag_sum_border_countries.
    """
    lag_cols = [F.col(f"cases_lag{i}") for i in range(1, lags + 1)]
    any_val = F.greatest(*[c.isNotNull() for c in lag_cols]) if lags > 1 else lag_cols[0].isNotNull()
    row_sum = F.when(any_val, sum(F.coalesce(c, F.lit(0)) for c in lag_cols))
    vals = lagged.select(
        F.col("country_iso3c").alias("country_border"),
        "disease", "disease_population", "taxa", "period",
        row_sum.alias("_s"),
    )
    edges = borders.where(F.col("shared_border") == "TRUE").select(
        F.col("country_origin").alias("country_iso3c"),
        F.col("country_destination").alias("country_border"),
    )
    summed = (
        vals.join(edges, on="country_border", how="inner")
        .groupBy("country_iso3c", "disease", "disease_population", "taxa", "period")
        .agg(F.sum("_s").alias("cases_lag_sum_border_countries"))
    )
    return summed


def ever_features(lagged: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """K6: the four "disease ever present before" features.

    Built on the full panel; continent variants group by continent directly
    (a null continent is its own group) and are joined back on continent.
    """
    present = F.col("disease_status") == K.STATUS_PRESENT
    base = with_continent(lagged.select("country_iso3c", "disease", "taxa", "period", "disease_status"),
                          countries)
    out = {
        "country_given_taxa": panel.ever_before(
            base, ["country_iso3c", "disease", "taxa"], "period", present,
            "ever_in_country_given_taxa"),
        "country_any_taxa": panel.ever_before(
            base, ["country_iso3c", "disease"], "period", present, "ever_in_country_any_taxa"),
        "continent_given_taxa": panel.ever_before(
            base, ["continent", "disease", "taxa"], "period", present,
            "ever_in_continent_given_taxa"),
        "continent_any_taxa": panel.ever_before(
            base, ["continent", "disease"], "period", present, "ever_in_continent_any_taxa"),
    }
    return out


def join_ever(df: DataFrame, ever: dict[str, DataFrame]) -> DataFrame:
    """Left-join the ever features; a null continent matches a null continent."""
    for e in ever.values():
        out_col = [c for c in e.columns if c.startswith("ever_in_")][0]
        keys = [c for c in e.columns if c != out_col]
        r = e.select(*[F.col(k).alias(f"_e_{k}") for k in keys], out_col)
        cond = [
            df[k].eqNullSafe(r[f"_e_{k}"]) if k == "continent" else df[k] == r[f"_e_{k}"]
            for k in keys
        ]
        df = df.join(r, on=cond, how="left").drop(*[f"_e_{k}" for k in keys])
    return df


def nowcast_features(spark: SparkSession, sf_dir: str, lags: int = 3) -> DataFrame:
    """K0-K9: the full nowcast feature table."""
    base = nowcast_base(spark, sf_dir, lags)
    return finish(preparation().fit(base).transform(base))


def nowcast_base(spark: SparkSession, sf_dir: str, lags: int = 3) -> DataFrame:
    """K0-K8: features before the fitted preparation (a checked stage)."""
    return stage(spark, sf_dir, f"nowcast_base{lags}", lambda: _nowcast_base(spark, sf_dir, lags), lambda df, name: checked_stage(df, BASE_SCHEMA, name))


def _nowcast_base(spark: SparkSession, sf_dir: str, lags: int) -> DataFrame:
    reports = init_reports(spark, sf_dir)
    lagged = panel_lagged(spark, sf_dir, lags)
    countries = B.countries(spark, sf_dir)
    aug = with_continent(lagged, countries)
    aug = control_flags(aug, lags)
    aug = aug.join(
        neighbour_lag_sum(lagged, B.shared_borders(spark, sf_dir), lags),
        on=["country_iso3c", "disease", "disease_population", "taxa", "period"],
        how="left",
    )
    aug = covariate_join(spark, sf_dir, aug)
    aug = aug.where(F.col("gdp_dollars").isNotNull())
    st_cols = ["disease_status"] + [f"disease_status_lag{i}" for i in range(1, lags + 1)]
    aug = status_columns_to_int(aug, st_cols)
    aug = join_ever(aug, ever_features(lagged, countries))
    lag_vars = [f"cases_lag{i}" for i in range(1, lags + 1)] + [
        f"disease_status_lag{i}" for i in range(1, lags + 1)
    ] + ["cases_lag_sum_border_countries"]
    aug = cov.missing_flags_zero_fill(aug, lag_vars)
    return panel.first_period_flag(
        aug, reports.withColumn("period", period_idx()), "country_iso3c", "period",
        "first_reporting_semester",
    )


def finish(df: DataFrame) -> DataFrame:
    """Flags as numbers, without the panel's working columns."""
    bools = [f.name for f in df.schema.fields if f.dataType.typeName() == "boolean" and f.name != "validation_set"]
    return df.withColumns({b: F.col(b).cast("double") for b in bools}).drop("control_measures", "period")


def covariate_join(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """K2: vets, taxa population, GDP, human population (+ missing flags)."""
    yr = {"country_iso3c": "country_iso3c", "report_year": "year"}
    df = cov.join_yearly(df, B.vets(spark, sf_dir), "veterinarian_count", yr)
    df = cov.join_yearly(
        df,
        B.taxa_population(spark, sf_dir).withColumnRenamed("population", "taxa_population"),
        "taxa_population",
        {**yr, "taxa": "taxa"},
    )
    df = cov.join_yearly(df, B.gdp(spark, sf_dir), "gdp_dollars", yr)
    df = cov.join_yearly(df, B.human_population(spark, sf_dir), "human_population", yr)
    return df


def preparation() -> Prepvar:
    """K9: log features with their fills; fit it on the rows that the model is fitted on."""
    log = lambda x: {"x": x, "transform": "log10"}
    return Prepvar(
        variables={
            "log_gdp_per_capita": log("try_divide(gdp_dollars, human_population)"),
            "log_veterinarians_per_taxa": log("(veterinarian_count + 1) / (taxa_population + 1)"),
            "log_taxa_population": log("taxa_population + 1"),
            "log_human_population": log("human_population"),
        },
        drop=["gdp_dollars", "veterinarian_count", "taxa_population", "human_population"])


#: Rolled-up reports: one row a key, known statuses.
REPORT_SCHEMA = TableSchema(
    required=[*KEY, "cases", "disease_status", "control_measures"], key=KEY, not_null=["country_iso3c", "report_year", "report_semester"],
    categories={"disease_status": [K.STATUS_PRESENT, K.STATUS_ABSENT, K.STATUS_UNREPORTED], "report_semester": [1, 2]},
    ranges={"cases": (0, None)})
#: Features before preparation: one row a key, nothing that the models need is missing.
BASE_SCHEMA = TableSchema(
    required=["gdp_dollars", "human_population", "taxa_population", "veterinarian_count"], key=KEY,
    not_null=["gdp_dollars", "cases_lag1", "disease_status_lag1", "cases_lag_sum_border_countries"],
    categories={"disease_status": [0, 1], "disease_status_lag1": [0, 1]})
