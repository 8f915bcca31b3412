"""Registered model queries (L1-L7, L13-L18, V8-V11); fitted models are
checked rows-only (no SQL equivalent of an iterative fit)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import mixed, models, ranks, scoring, splits
from ..sources import bindings as B
from . import network as NW
from . import nowcast as N
from . import oracle as O
from . import reads
from .queries_misc import _nowcast_split, split_monthly
from .queries_readside import PRIORITY
from .registry import register
from .stages import stage

KEY = K.NOWCAST_KEY
_FITS: dict = {}
TUNING_SETS, TUNING_BURN_IN = 6, 2  # parameter sets of the space-filling design, folds before the first are dropped


def _features(spark, sf_dir):
    """Every feature row, prepared with the numbers of the training rows."""
    base = N.nowcast_base(spark, sf_dir)
    return stage(spark, sf_dir, "nowcast_features_prepared", lambda: N.finish(_preparation(spark, sf_dir).transform(base)))


def _split_base(spark, sf_dir):
    def build():
        return splits.attach_split(N.nowcast_base(spark, sf_dir), _nowcast_split(spark, sf_dir), KEY)

    return stage(spark, sf_dir, "nowcast_base_split", build)


def _preparation(spark, sf_dir):
    """K9 fitted once, on the training rows."""
    k = (spark.sparkContext.applicationId, sf_dir, "preparation")
    if k not in _FITS:
        _FITS[k] = N.preparation().fit(splits.training_rows(_split_base(spark, sf_dir)))
    return _FITS[k]


def _split_features(spark, sf_dir):
    def build():
        return N.finish(_preparation(spark, sf_dir).transform(_split_base(spark, sf_dir)))

    return stage(spark, sf_dir, "nowcast_features_split", build)


def _hurdle(spark, sf_dir):
    k = (spark.sparkContext.applicationId, sf_dir, "hurdle")
    if k not in _FITS:
        train = splits.training_rows(_split_features(spark, sf_dir))
        _FITS[k] = (models.fit_status(train), models.fit_cases(train))
    return _FITS[k]


def _validation(spark, sf_dir):
    return splits.validation_rows(_split_features(spark, sf_dir))


@register("boosted_status")
def boosted_status(spark, sf_dir):
    """L2: status classifier predictions on the validation rows."""
    st, cs = _hurdle(spark, sf_dir)
    pred = models.hurdle_predict(st, cs, _validation(spark, sf_dir), KEY)
    return pred.select(*KEY, "disease_status", "disease_status_predicted", "status_probability")


@register("boosted_cases")
def boosted_cases(spark, sf_dir):
    """L3: case regression (log10 scale, back-transformed) on all validation rows."""
    st, cs = _hurdle(spark, sf_dir)
    val = _validation(spark, sf_dir)  # every row; the training filter is no filter of what is predicted
    pred = cs.model.transform(models.recipe_columns(val))
    return pred.select(*KEY, "cases", F.bround(F.pow(F.lit(10.0), F.col("prediction")), 0).alias(
        "cases_predicted_unhurdled"))


@register("hurdle_forecast")
def hurdle_forecast(spark, sf_dir):
    """L7 + L17: hurdle forecast for every feature row."""
    st, cs = _hurdle(spark, sf_dir)
    return models.hurdle_predict(st, cs, _features(spark, sf_dir), KEY).select(
        *KEY, "disease_status_predicted", "status_probability", "cases_predicted")


@register("cv_one_se")
def cv_one_se(spark, sf_dir):
    """L4 + L5: seven parameters raced over stratified folds, with the folds each set survived and the one-SE choice."""
    train = splits.training_rows(_split_features(spark, sf_dir))
    tunings = (("disease_status", models.tune_status_model), ("cases", models.tune_cases_model))

    def raced(tune):
        return tune(train, KEY, points=models.space_filling(TUNING_SETS), burn_in=TUNING_BURN_IN, parallelism=TUNING_SETS)

    rows = []
    with ThreadPoolExecutor(len(tunings)) as pool:  # fits are many short jobs that leave cores idle: both models are raced side by side
        for (name, _), tuned in zip(tunings, pool.map(inheritable_thread_target(spark)(raced), [tune for _, tune in tunings])):
            for point, mean, sd, folds, chosen in tuned.cv_table:
                rows.append((name, ", ".join(f"{k}={v}" for k, v in sorted(point.items())), *map(float, point.values()), mean, sd, folds, chosen))
    names = ", ".join(f"{v} double" for v in models.TUNED_PARAMETERS)
    return spark.createDataFrame(
        rows, f"model string, params string, {names}, metric_mean double, metric_sd double, folds int, chosen boolean")


@register("stratified_folds", O.with_(O.baseline_ctes(), f"""
SELECT {O.KEY}, CAST(disease_status AS BIGINT) AS disease_status,
  (row_number() OVER (PARTITION BY disease_status ORDER BY md5(concat_ws('|', '400', {', '.join(KEY)})), {', '.join(KEY)}) - 1) % 10 AS fold
FROM baseline WHERE disease_status IS NOT NULL"""))
def stratified_folds(spark, sf_dir):
    """L4: ten folds of the rows with a known status, sizes per class differing by one at most."""
    def build():
        return N.forecast_baseline(spark, sf_dir).where("disease_status IS NOT NULL").select(*KEY, "disease_status")

    return splits.stratified_folds(stage(spark, sf_dir, "fold_rows", build), KEY, 10, ["disease_status"])


SAMPLE_ROWS = 500


@register("fixed_sample", O.with_(O.baseline_ctes(), f"""
SELECT {O.KEY}, CAST(disease_status AS BIGINT) AS disease_status, CAST(cases AS BIGINT) AS cases FROM baseline
ORDER BY md5(concat_ws('|', '9', {', '.join(KEY)})) LIMIT {SAMPLE_ROWS}"""))
def fixed_sample(spark, sf_dir):
    """500 rows of the nowcast panel, the same ones at any layout."""
    def build():
        return N.forecast_baseline(spark, sf_dir).select(*KEY, "disease_status", "cases")

    return ranks.hash_sample(stage(spark, sf_dir, "sample_rows", build), KEY, SAMPLE_ROWS, seed=9)


def _both_models(spark, sf_dir):
    """Scored validation rows of the baseline and the boosted model."""
    def build():
        st, cs = _hurdle(spark, sf_dir)
        val = _validation(spark, sf_dir)
        boosted = models.hurdle_predict(st, cs, val, KEY)
        base = scoring.persistence_forecast(val)
        cols = [*KEY, "continent", "disease_status", "cases", "cases_lag1", "disease_status_lag1",
                "disease_status_predicted", "cases_predicted"]
        both = boosted.select(*cols).withColumn("model", F.lit("boosted")).unionByName(
            base.select(*cols).withColumn("model", F.lit("baseline")))
        return scoring.score_rows(both, KEY + ["model", "continent"])

    return stage(spark, sf_dir, "scored_models", build)


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """V2-V4 on validation rows: baseline persistence vs boosted hurdle."""
    scored = _both_models(spark, sf_dir)
    cm = scoring.confusion_matrix(scored, "disease_status_actual", "disease_status_predicted", ["model"])
    return scoring.class_metrics(cm, ["model"])


@register("model_accuracy_by_slice")
def model_accuracy_by_slice(spark, sf_dir):
    """V5 on validation rows: accuracy of both models by disease / taxa / continent, overall and on outbreak starts."""
    return scoring.accuracy_by_slice(_both_models(spark, sf_dir), ["disease", "taxa", "continent"])


@register("model_case_metrics")
def model_case_metrics(spark, sf_dir):
    """V6 on validation rows: RMSE, R-squared and MAE of both models, over all rows and over outbreak starts."""
    scored = _both_models(spark, sf_dir)
    start = F.col("disease_status_dirchange_actual") == "outbreak starts"
    rows = scored.withColumn("rows", F.explode(F.when(start, F.array(F.lit("all"), F.lit("new"))).otherwise(F.array(F.lit("all")))))
    return scoring.regression_metrics(rows, "cases_actual", "cases_predicted", ["rows", "model"])


@register("correct_starts")
def correct_starts(spark, sf_dir):
    """Validation rows where a true outbreak start was predicted."""
    st, cs = _hurdle(spark, sf_dir)
    boosted = models.hurdle_predict(st, cs, _validation(spark, sf_dir), KEY)
    scored = scoring.score_rows(boosted, KEY)
    return scored.where(
        (F.col("disease_status_dirchange_actual") == "outbreak starts")
        & (F.col("disease_status_dirchange_predicted") == "outbreak starts"))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """V8: top-12 gain importances of the status and the cases model, with labels."""
    rows = [(name, *r, models.feature_label(r[0])) for name, m in zip(("disease_status", "cases"), _hurdle(spark, sf_dir))
            for r in models.feature_importance(m, 12)]
    return spark.createDataFrame(rows, "model string, feature string, importance double, label string")


STATUS_LAGS = ["disease_status_lag1", "disease_status_lag2", "disease_status_lag3"]
PROFILED = ["log_veterinarians_per_taxa", "log_gdp_per_capita", "cases_lag_sum_border_countries"]
PROFILE_LEVELS = 11


def _priority_rows(spark, sf_dir):
    return _validation(spark, sf_dir).where(F.col("disease").isin(PRIORITY))


@register("status_lag_profiles")
def status_lag_profiles(spark, sf_dir):
    """V9: status probability of the priority diseases with each status lag forced to absent and present."""
    st, _ = _hurdle(spark, sf_dir)
    profile = models.profiles(st, _priority_rows(spark, sf_dir), {v: [0.0, 1.0] for v in STATUS_LAGS}, ["disease"])
    return models.presence_effects(profile, ["disease"])


@register("cases_profiles")
def cases_profiles(spark, sf_dir):
    """V9: relative range of predicted cases of the priority diseases over three variables' own values."""
    _, cs = _hurdle(spark, sf_dir)
    rows = models.cases_training_rows(_priority_rows(spark, sf_dir))
    grids = {v: models.level_grid(rows, v, PROFILE_LEVELS) for v in PROFILED}
    return models.range_effects(models.profiles(cs, rows, grids, ["disease"]), ["disease"])


@register("partial_dependence")
def partial_dependence(spark, sf_dir):
    """V9: mean status probability by disease as last period's cases varies, with its effect."""
    st, _ = _hurdle(spark, sf_dir)
    return models.partial_dependence(st, _validation(spark, sf_dir), "cases_lag1",
                                     [0, 1, 10, 100, 1000], ["disease"])


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    """Accuracy and loss with each predictor permuted, over the correctly predicted outbreak starts."""
    st, _ = _hurdle(spark, sf_dir)
    val = _validation(spark, sf_dir)
    starts = correct_starts(spark, sf_dir).select(*KEY).distinct().withColumn("correct_start", F.lit(True))
    val = val.join(starts, KEY, "left").withColumn("label", F.col("disease_status").cast("double"))
    return models.permutation_importance(
        st, val, models.recipe_predictors(st), KEY, "disease_status", rows=F.col("correct_start"))


# ---- mixed-effects network model -------------------------------------------------------
def _network_training(spark, sf_dir):
    """S3 + S4 + L9: fitting rows of the network family's training set."""
    def build():
        split = split_monthly(spark, sf_dir)
        key = ["country_iso3c", "disease", "month"]
        feats = splits.attach_split(NW.network_features(spark, sf_dir), split, key)
        return NW.fit_rows(splits.training_rows(feats))

    return stage(spark, sf_dir, "network_training", build)


def _network_scaling(spark, sf_dir):
    """Scaling values of the training rows; fitting and prediction share them."""
    k = (spark.sparkContext.applicationId, sf_dir, "scaling")
    if k not in _FITS:
        _FITS[k] = NW.Scaling.from_table(NW.scaling_stats(_network_training(spark, sf_dir)))
    return _FITS[k]


def _design(spark, sf_dir, predictors):
    """Standardised training rows + continent one-hot, weight-compressed."""
    def build():
        z = NW.standardise_with(_network_training(spark, sf_dir), _network_scaling(spark, sf_dir))
        levels = sorted(r[0] for r in z.select("continent").distinct().collect() if r[0] is not None)
        z = z.withColumns({f"continent{c}": (F.col("continent") == c).cast("double") for c in levels})
        cols = ["disease", "outbreak_start", *NW.SCALED, *[f"continent{c}" for c in levels]]
        return z.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))

    d = stage(spark, sf_dir, "network_design", build)
    cont = [c for c in d.columns if c.startswith("continent")]
    return d, [p for p in predictors if p != "continent"] + (cont if "continent" in predictors else [])


#: Predictors of the compared formulas (L13, L16, L18); the last one has no scaled predictor at all.
FORMULAS = {"full": B.PREDICTOR_VARS, "baseline": ["continent", "disease_present_anywhere"], "continent": ["continent"]}


def _mixed(spark, sf_dir, formula: str = "full"):
    k = (spark.sparkContext.applicationId, sf_dir, "mixed", formula)
    if k not in _FITS:
        d, cols = _design(spark, sf_dir, FORMULAS[formula])
        continents = [c for c in cols if c.startswith("continent")]  # one correlated block
        _FITS[k] = mixed.fit_mixed_logit(d, cols, "outbreak_start", "disease", "count", block=continents)
    return _FITS[k]


@register("mixed_logit_coefficients")
def mixed_logit_coefficients(spark, sf_dir):
    """L13 + L14: fitted intercept and per-disease random slopes (long form)."""
    return _mixed(spark, sf_dir).coefficients(spark)


@register("mixed_logit_variances")
def mixed_logit_variances(spark, sf_dir):
    """Variance of each random slope across diseases."""
    return _mixed(spark, sf_dir).variance_table(spark)


@register("mixed_logit_predict")
def mixed_logit_predict(spark, sf_dir):
    """Outbreak-start probability from the fitted mixed model, every cell."""
    fit = _mixed(spark, sf_dir)
    z = NW.standardise_with(NW.network_features(spark, sf_dir), _network_scaling(spark, sf_dir))
    conts = [p for p in fit.predictors if p.startswith("continent")]
    z = z.withColumns({c: (F.col("continent") == c[len("continent"):]).cast("double") for c in conts})
    return mixed.predict(z, fit).select("country_iso3c", "disease", "month", "predicted_outbreak_probability")


def _fitted_reads(spark, sf_dir):
    """Reads of the fitted model, published for the current month."""
    return reads.reads(spark, sf_dir, "fitted", lambda: reads.fitted_tables(
        spark, sf_dir, _mixed(spark, sf_dir), _network_scaling(spark, sf_dir)), [reads.month_of(B.AS_OF)])


@register("fitted_forecast")
def fitted_forecast(spark, sf_dir):
    """The fitted model's published forecast of the current month, every country and disease."""
    return _fitted_reads(spark, sf_dir).table("augment_predict").select(
        "country_iso3c", "disease", "month", "predicted_outbreak_probability")


@register("fitted_variable_importance")
def fitted_variable_importance(spark, sf_dir):
    """Y2 from the fitted model: priority diseases, current month."""
    return _fitted_reads(spark, sf_dir).variable_importance()


@register("fitted_origin_import_risk")
def fitted_origin_import_risk(spark, sf_dir):
    """Y3 + Y4 from the fitted model: priority diseases, current month."""
    return _fitted_reads(spark, sf_dir).origin_import_risk()


@register("fitted_priority_coefficients")
def fitted_priority_coefficients(spark, sf_dir):
    """Y5 from the fitted model: slopes of the priority diseases."""
    return _fitted_reads(spark, sf_dir).table("coefficients", disease=PRIORITY)


@register("model_aic")
def model_aic(spark, sf_dir):
    """L16 + L18: logLik / AIC / BIC of the full and the baseline network model."""
    tables = [_mixed(spark, sf_dir, f).summary(spark).withColumn("model", F.lit(f)) for f in ("full", "baseline")]
    return reduce(DataFrame.unionByName, tables)


@register("continent_model")
def continent_model(spark, sf_dir):
    """L16 + L18: the continent-only network model, which has no scaled predictor."""
    return _mixed(spark, sf_dir, "continent").summary(spark)
