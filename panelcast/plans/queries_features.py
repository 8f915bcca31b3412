"""Registered nowcast feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import _py_clean, safe_div, safe_log10
from ..functions.periods import period_idx, semester_of_period, year_of_period
from ..operators import covariates as cov
from ..operators import panel
from ..sources import bindings as B
from . import nowcast as N
from . import oracle as O
from . import oracle_network as ON
from .registry import register

KEY_BIG = (
    "country_iso3c, CAST(report_year AS BIGINT) AS report_year, "
    "CAST(report_semester AS BIGINT) AS report_semester, disease, disease_population, taxa"
)
CONTROL_COLS = ["control_" + _py_clean(m) for m in K.CONTROL_MEASURES]


def _flags_sql(src: str) -> str:
    txt = "concat_ws('; ', control_measures_lag1, control_measures_lag2, control_measures_lag3)"
    return ", ".join(
        f"CAST(coalesce(contains({txt}, {O.q(m)}), false) AS BIGINT) AS {c}"
        for m, c in zip(K.CONTROL_MEASURES, CONTROL_COLS)
    )


def feature_ctes():
    """CTEs of the full nowcast feature table (aug -> nfeat)."""
    lag_names = [f"cases_lag{i}" for i in range(1, 4)] + [f"disease_status_lag{i}" for i in range(1, 4)]
    miss = lag_names + ["cases_lag_sum_border_countries"]
    st_cols = ["disease_status"] + [f"disease_status_lag{i}" for i in range(1, 4)]
    return O.lag_ctes(3) + ON.covariate_ctes() + ON.links_ctes()[:1] + [
        ("nb", """
SELECT b.country_origin AS country_iso3c, l.disease, l.disease_population, l.taxa, l.period,
       sum(CASE WHEN l.cases_lag1 IS NULL AND l.cases_lag2 IS NULL AND l.cases_lag3 IS NULL THEN NULL
                ELSE coalesce(l.cases_lag1, 0) + coalesce(l.cases_lag2, 0) + coalesce(l.cases_lag3, 0) END)
         AS cases_lag_sum_border_countries
FROM lagged l JOIN b4 b ON b.country_destination = l.country_iso3c AND b.shared_border = 'TRUE'
GROUP BY ALL"""),
        ("aug1", f"""
SELECT l.country_iso3c, l.disease, l.disease_population, l.taxa, l.period, l.report_year, l.report_semester,
       l.cases, l.disease_status, l.control_measures,
       l.cases_lag1, l.cases_lag2, l.cases_lag3,
       l.disease_status_lag1, l.disease_status_lag2, l.disease_status_lag3,
       co.continent, {_flags_sql('l')}, nb.cases_lag_sum_border_countries,
       v.veterinarian_count, v.veterinarian_count IS NULL AS veterinarian_count_missing,
       tp.population AS taxa_population, tp.population IS NULL AS taxa_population_missing,
       g.gdp_dollars, g.gdp_dollars IS NULL AS gdp_dollars_missing,
       h.human_population, h.human_population IS NULL AS human_population_missing
FROM lagged l
LEFT JOIN countries co ON l.country_iso3c = co.country_iso3c
LEFT JOIN nb ON l.country_iso3c = nb.country_iso3c AND l.disease = nb.disease
  AND l.disease_population = nb.disease_population AND l.taxa = nb.taxa AND l.period = nb.period
LEFT JOIN vets v ON l.country_iso3c = v.country_iso3c AND l.report_year = v.year
LEFT JOIN taxa_pop tp ON l.country_iso3c = tp.country_iso3c AND l.report_year = tp.year AND l.taxa = tp.taxa
LEFT JOIN gdp g ON l.country_iso3c = g.country_iso3c AND l.report_year = g.year
LEFT JOIN hpop h ON l.country_iso3c = h.country_iso3c AND l.report_year = h.year"""),
        ("aug2", "SELECT * REPLACE ("
         + ", ".join(f"{O.status_int(c)} AS {c}" for c in st_cols)
         + "), "
         + ", ".join(f"CAST({c} = 'unreported' AS INTEGER) AS {c}_unreported" for c in st_cols)
         + " FROM aug1 WHERE gdp_dollars IS NOT NULL"),
        ("ever_base", """
SELECT l.country_iso3c, co.continent, l.disease, l.taxa, l.period,
       CASE WHEN l.disease_status = 'present' THEN 1 ELSE 0 END AS f
FROM lagged l LEFT JOIN countries co ON l.country_iso3c = co.country_iso3c"""),
    ] + [_ever_cte(name, grp) for name, grp in EVER] + [
        ("aug3", f"""
SELECT a.*, {', '.join(f'e_{n}.ever_in_{n}' for n, _ in EVER)}
FROM aug2 a
{' '.join(_ever_join(n, g) for n, g in EVER)}"""),
        ("first_rep", """
SELECT country_iso3c, min(report_year * 2 + report_semester - 1) AS first_period FROM recoded GROUP BY country_iso3c"""),
        ("aug4", "SELECT a.* REPLACE ("
         + ", ".join(f"coalesce({c}, 0) AS {c}" for c in miss)
         + "), "
         + ", ".join(f"{c} IS NULL AS {c}_missing" for c in miss)
         + ", coalesce(a.period = fr.first_period, false) AS first_reporting_semester"
         + " FROM aug3 a LEFT JOIN first_rep fr ON a.country_iso3c = fr.country_iso3c"),
        ("nfeat", f"""
SELECT * EXCLUDE (gdp_dollars, veterinarian_count, taxa_population, human_population, control_measures, period),
       {_prep('CASE WHEN human_population = 0 THEN NULL ELSE gdp_dollars / human_population END')} AS log_gdp_per_capita,
       {_prep('(veterinarian_count + 1) / (taxa_population + 1)')} AS log_veterinarians_per_taxa,
       {_prep('(taxa_population + 1)')} AS log_taxa_population,
       {_prep('human_population')} AS log_human_population
FROM aug4"""),
    ]


def _prep(x: str) -> str:
    return ON.prep_sql(f"({x})", "aug4")


EVER = [
    ("country_given_taxa", ["country_iso3c", "disease", "taxa"]),
    ("country_any_taxa", ["country_iso3c", "disease"]),
    ("continent_given_taxa", ["continent", "disease", "taxa"]),
    ("continent_any_taxa", ["continent", "disease"]),
]


def _ever_cte(name, grp):
    g = ", ".join(grp)
    return (f"e_{name}", f"""
SELECT {g}, period, CAST(coalesce(max(f) OVER (PARTITION BY {g} ORDER BY period
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS ever_in_{name}
FROM (SELECT {g}, period, max(f) AS f FROM ever_base GROUP BY {g}, period) t""")


def _ever_join(name, grp):
    cond = " AND ".join(
        (f"a.{c} IS NOT DISTINCT FROM e_{name}.{c}" if c == "continent" else f"a.{c} = e_{name}.{c}")
        for c in grp + ["period"]
    )
    return f"LEFT JOIN e_{name} ON {cond}"


# ---- C14 ---------------------------------------------------------------------------
@register(
    "control_flags",
    O.with_(O.lag_ctes(3), f"SELECT {KEY_BIG}, {_flags_sql('lagged')} FROM lagged"),
)
def control_flags(spark, sf_dir):
    """C14: one 0/1 column per control measure from the lagged measure text."""
    lag = N.panel_lagged(spark, sf_dir, 3)
    return N.control_flags(lag, 3).select(*K.NOWCAST_KEY, *CONTROL_COLS)


# ---- K15 ---------------------------------------------------------------------------
@register(
    "neighbour_lag_sum",
    O.with_(feature_ctes()[: len(O.lag_ctes(3)) + len(ON.covariate_ctes()) + 2],
            """SELECT country_iso3c, disease, disease_population, taxa,
       CAST(floor(period / 2) AS BIGINT) AS report_year, CAST(period % 2 + 1 AS BIGINT) AS report_semester,
       CAST(cases_lag_sum_border_countries AS BIGINT) AS cases_lag_sum_border_countries FROM nb"""),
)
def neighbour_lag_sum(spark, sf_dir):
    """Lag 1-3 cases summed over bordering countries, per cell."""
    lag = N.panel_lagged(spark, sf_dir, 3)
    s = N.neighbour_lag_sum(lag, B.shared_borders(spark, sf_dir), 3)
    return s.select(
        "country_iso3c", "disease", "disease_population", "taxa",
        year_of_period("period").alias("report_year"), semester_of_period("period").alias("report_semester"),
        "cases_lag_sum_border_countries",
    )


# ---- K2 / K4 -------------------------------------------------------------------------
COV_OUT = ["veterinarian_count", "veterinarian_count_missing", "taxa_population", "taxa_population_missing",
           "gdp_dollars", "gdp_dollars_missing", "human_population", "human_population_missing"]


@register(
    "covariate_join",
    O.with_(feature_ctes(), f"SELECT {KEY_BIG}, {', '.join(COV_OUT)} FROM aug1".replace(
        "gdp_dollars,", "round(gdp_dollars, 4) AS gdp_dollars,").replace(
        "veterinarian_count,", "round(veterinarian_count, 4) AS veterinarian_count,").replace(
        "taxa_population,", "round(taxa_population, 4) AS taxa_population,").replace(
        "human_population,", "round(human_population, 4) AS human_population,")),
)
def covariate_join(spark, sf_dir):
    """K2: yearly vets, taxa population, GDP and population with missing flags."""
    lag = N.panel_lagged(spark, sf_dir, 3).select(*K.NOWCAST_KEY)
    return N.covariate_join(spark, sf_dir, lag).select(*K.NOWCAST_KEY, *COV_OUT)


@register(
    "drop_missing_gdp",
    O.with_(feature_ctes(), """SELECT country_iso3c, count(*) AS n_rows_dropped FROM aug1
WHERE gdp_dollars IS NULL GROUP BY country_iso3c"""),
)
def drop_missing_gdp(spark, sf_dir):
    """K4 + B9: rows without GDP, counted per country (the dropped-row report)."""
    lag = N.panel_lagged(spark, sf_dir, 3).select(*K.NOWCAST_KEY)
    return cov.missing_report(N.covariate_join(spark, sf_dir, lag), "gdp_dollars", ["country_iso3c"])


# ---- K6 / F2 --------------------------------------------------------------------------
def _register_ever(name, grp):
    g = ", ".join(grp)

    @register(
        f"ever_before_{name}",
        O.with_(feature_ctes(), f"""SELECT {g}, CAST(floor(period / 2) AS BIGINT) AS report_year,
       CAST(period % 2 + 1 AS BIGINT) AS report_semester, CAST(ever_in_{name} AS BIGINT) AS ever_in_{name}
FROM e_{name}"""),
    )
    def q(spark, sf_dir):
        lag = N.panel_lagged(spark, sf_dir, 3)
        e = N.ever_features(lag, B.countries(spark, sf_dir))[name]
        return e.select(*grp, year_of_period("period").alias("report_year"),
                        semester_of_period("period").alias("report_semester"), f"ever_in_{name}")

    q.__doc__ = f"K6/F2: disease present before in the {name.replace('_', ' ')} group."
    return q


for _n, _g in EVER:
    _register_ever(_n, _g)


# ---- M1 --------------------------------------------------------------------------------
@register(
    "prepvar_gdp_per_capita",
    O.with_(ON.covariate_ctes() + [("gh", """
SELECT coalesce(g.country_iso3c, h.country_iso3c) AS country_iso3c, coalesce(g.year, h.year) AS year,
       g.gdp_dollars, h.human_population
FROM gdp g FULL OUTER JOIN hpop h ON g.country_iso3c = h.country_iso3c AND g.year = h.year""")],
            f"""SELECT country_iso3c, year,
       round({ON.prep_sql('(CASE WHEN human_population = 0 THEN NULL ELSE gdp_dollars / human_population END)', 'gh')}, 4)
         AS log_gdp_per_capita,
       round({ON.prep_sql('human_population', 'gh')}, 4) AS log_human_population
FROM gh"""),
)
def prepvar_gdp_per_capita(spark, sf_dir):
    """M1: log10 transform with the data-driven fill for missing values."""
    g = B.gdp(spark, sf_dir).join(B.human_population(spark, sf_dir), on=["country_iso3c", "year"], how="full")
    cols = cov.prepvar_columns(g, {
        "log_gdp_per_capita": (safe_div(F.col("gdp_dollars"), F.col("human_population")), safe_log10, "zero"),
        "log_human_population": (F.col("human_population"), safe_log10, "zero"),
    })
    return g.select("country_iso3c", "year", *[c.alias(n) for n, c in cols.items()])


# ---- K8 ----------------------------------------------------------------------------------
@register(
    "first_reporting_period",
    O.with_(O.lookup_ctes(), """SELECT country_iso3c,
       CAST(floor(min(report_year * 2 + report_semester - 1) / 2) AS BIGINT) AS first_report_year,
       CAST(min(report_year * 2 + report_semester - 1) % 2 + 1 AS BIGINT) AS first_report_semester
FROM recoded GROUP BY country_iso3c"""),
)
def first_reporting_period(spark, sf_dir):
    """K8: first semester in which each country actually reported."""
    r = N.init_reports(spark, sf_dir).withColumn("period", period_idx())
    first = r.groupBy("country_iso3c").agg(F.min("period").alias("p"))
    return first.select("country_iso3c", year_of_period("p").alias("first_report_year"),
                        semester_of_period("p").alias("first_report_semester"))


# ---- K0-K9 -------------------------------------------------------------------------------
def _feature_columns(spark, sf_dir):
    return N.nowcast_features(spark, sf_dir)


@register("nowcast_features", None)
def nowcast_features(spark, sf_dir):
    """K0-K9: the complete nowcast feature table (oracle attached below)."""
    return N.nowcast_features(spark, sf_dir)


def _nowcast_features_sql() -> str:
    from . import registry

    cols = NOWCAST_FEATURE_COLUMNS
    dbls = {"log_gdp_per_capita", "log_veterinarians_per_taxa", "log_taxa_population", "log_human_population"}
    bools = {c for c in cols if c.endswith("_missing") or c == "first_reporting_semester"}
    ints = {"report_year", "report_semester"}
    sel = []
    for c in cols:
        if c in dbls:
            sel.append(f"round({c}, 4) AS {c}")
        elif c in bools:
            sel.append(f"round(CAST({c} AS DOUBLE), 4) AS {c}")
        elif c in ints or c.startswith(("control_", "ever_in_")) or c.endswith("_unreported") \
                or c.startswith(("cases", "disease_status")):
            sel.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            sel.append(c)
    registry.ORACLES["nowcast_features"] = O.with_(feature_ctes(), f"SELECT {', '.join(sel)} FROM nfeat")


NOWCAST_FEATURE_COLUMNS = (
    ["country_iso3c", "disease", "disease_population", "taxa", "report_year", "report_semester",
     "cases", "disease_status", "cases_lag1", "cases_lag2", "cases_lag3",
     "disease_status_lag1", "disease_status_lag2", "disease_status_lag3", "continent"]
    + CONTROL_COLS
    + ["cases_lag_sum_border_countries"]
    + ["veterinarian_count_missing", "taxa_population_missing", "gdp_dollars_missing",
       "human_population_missing"]
    + ["disease_status_unreported"] + [f"disease_status_lag{i}_unreported" for i in range(1, 4)]
    + [f"ever_in_{n}" for n, _ in EVER]
    + [f"{c}_missing" for c in [f"cases_lag{i}" for i in range(1, 4)]
       + [f"disease_status_lag{i}" for i in range(1, 4)] + ["cases_lag_sum_border_countries"]]
    + ["first_reporting_semester", "log_gdp_per_capita", "log_veterinarians_per_taxa",
       "log_taxa_population", "log_human_population"]
)
_nowcast_features_sql()


LAG_FLAGS = [c for c in NOWCAST_FEATURE_COLUMNS if c.endswith("_missing") and ("lag" in c)]


@register(
    "missing_lag_flags",
    O.with_(feature_ctes(), "SELECT disease, count(*) AS n_rows, "
            + ", ".join(f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) > 0) AS {c}" for c in LAG_FLAGS) + " FROM nfeat GROUP BY disease"),
)
def missing_lag_flags(spark, sf_dir):
    """K7: rows per disease whose lagged value was missing and became 0."""
    base = N.nowcast_base(spark, sf_dir)
    return base.groupBy("disease").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c)).alias(c) for c in LAG_FLAGS])


@register(
    "cases_filled_down",
    O.with_(O.grid_ctes(), f"""SELECT {KEY_BIG}, CAST(last(cases IGNORE NULLS) OVER (
  PARTITION BY {O.SERIES} ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cases FROM dense"""),
)
def cases_filled_down(spark, sf_dir):
    """each series' last known number of cases."""
    dense = N.panel_lagged(spark, sf_dir, 3).select(*K.NOWCAST_KEY, "period", "cases")
    return panel.fill_down(dense, K.NOWCAST_SERIES, "period", ["cases"]).drop("period")


# ---- K14 / C15 ---------------------------------------------------------------------------
RARE_CONDITION_MIN = 1000  # fixed value: conditions seen fewer times are lumped


@register(
    "gam_features",
    O.with_(O.lag_ctes(3) + [("gcond", """
SELECT *, disease || '-' || taxa AS cond0, count(*) OVER (PARTITION BY disease || '-' || taxa) AS cond_n
FROM lagged""")], f"""SELECT {KEY_BIG},
       CASE WHEN cond_n < {RARE_CONDITION_MIN} THEN 'rare_condition' ELSE cond0 END AS condition,
       [CAST(cases_lag1 AS BIGINT), CAST(cases_lag2 AS BIGINT), CAST(cases_lag3 AS BIGINT)] AS cases_lagged,
       [CAST(1 AS BIGINT), 2, 3] AS lags
FROM gcond"""),
)
def gam_features(spark, sf_dir):
    """K14 + C15: lag vector, lag index and the disease-taxa condition with
    conditions seen fewer than 1000 times lumped into "rare_condition"."""
    from ..operators.rollup import lump_rare

    lag = N.panel_lagged(spark, sf_dir, 3).withColumn(
        "condition", F.concat_ws("-", "disease", "taxa"))
    lag = lump_rare(lag, "condition", RARE_CONDITION_MIN, "rare_condition")
    return lag.select(
        *K.NOWCAST_KEY, "condition",
        F.array(*[F.col(f"cases_lag{i}") for i in range(1, 4)]).alias("cases_lagged"),
        F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long")).alias("lags"),
    )


# ---- E4 / E8 / E9 -------------------------------------------------------------------------
@register(
    "disease_count_summary",
    O.with_(O.rollup_ctes() + [("dc", "SELECT disease, count(*) AS n FROM rolled GROUP BY disease")], """
SELECT CAST(min(n) AS BIGINT) AS n_min, round(quantile_cont(n, 0.25), 4) AS n_q1,
       round(quantile_cont(n, 0.5), 4) AS n_median, round(avg(n), 4) AS n_mean,
       round(quantile_cont(n, 0.75), 4) AS n_q3, CAST(max(n) AS BIGINT) AS n_max,
       round(quantile_cont(n, 0.15), 4) AS rare_threshold, count(*) AS n_diseases
FROM dc"""),
)
def disease_count_summary(spark, sf_dir):
    """E4 + E8 + E9: five-number summary of cells per disease and the rare threshold."""
    dc = N.rolled_reports(spark, sf_dir).groupBy("disease").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    return dc.agg(
        F.min("n").alias("n_min"), F.percentile(n, 0.25).alias("n_q1"),
        F.percentile(n, 0.5).alias("n_median"), F.avg(n).alias("n_mean"),
        F.percentile(n, 0.75).alias("n_q3"), F.max("n").alias("n_max"),
        F.percentile(n, 0.15).alias("rare_threshold"), F.count(F.lit(1)).alias("n_diseases"),
    )


HIST_BINS = 10


@register(
    "disease_count_histogram",
    O.with_(O.rollup_ctes() + [("dc", "SELECT disease, count(*) AS n FROM rolled GROUP BY disease")], f"""
SELECT CAST(CASE WHEN n >= mx THEN {HIST_BINS} ELSE floor((n - mn) / ((mx - mn) / {HIST_BINS})) + 1 END AS BIGINT) AS bucket,
       count(*) AS n_diseases
FROM dc, (SELECT min(n) AS mn, max(n) AS mx FROM dc) b GROUP BY ALL"""),
)
def disease_count_histogram(spark, sf_dir):
    """Histogram of cells per disease (equal-width buckets)."""
    dc = N.rolled_reports(spark, sf_dir).groupBy("disease").agg(F.count(F.lit(1)).alias("n"))
    rng = dc.agg(F.struct(F.min("n").alias("mn"), F.max("n").alias("mx"))).scalar()
    bucket = F.when(F.col("n") >= rng.getField("mx"), F.lit(HIST_BINS)).otherwise(
        F.width_bucket(F.col("n").cast("double"), rng.getField("mn").cast("double"),
                       rng.getField("mx").cast("double"), F.lit(HIST_BINS)))
    return dc.groupBy(bucket.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n_diseases"))
