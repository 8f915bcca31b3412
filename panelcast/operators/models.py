"""Hurdle nowcast models on Spark ML (L1-L7) and their explanations.

Status: boosted-tree classifier of disease presence.  Cases: boosted-tree
regression of log10(cases) (0 -> 0.1) on rows with cases or last-period
cases.  Prediction: cases = round-half-even(10^pred), forced to 0 where the
predicted status is 0.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import hash_rank, value_ranks
from .splits import stratified_folds

STRING_FEATURES = ["disease", "taxa", "country_iso3c", "continent", "disease_population"]
LOG_LAGS = ["cases_lag1", "cases_lag2", "cases_lag3", "cases_lag_sum_border_countries"]
STATUS_DROP = ["report_year", "report_semester", "cases", "disease_status"]
CASES_DROP = ["report_year", "report_semester", "cases", "disease_status"]


def recipe_columns(df: DataFrame) -> DataFrame:
    """L1 (row-wise part): semester indicator, lag cases 0 -> 0.1 then log10,
    unreported markers removed."""
    out = df.withColumn("report_semester_1", (F.col("report_semester") == 1).cast("double"))
    out = out.withColumns(
        {c: F.log10(F.when(F.col(c) == 0, F.lit(0.1)).otherwise(F.col(c).cast("double")))
         for c in LOG_LAGS if c in df.columns}
    )
    return out.drop(*[c for c in df.columns if c.endswith("_unreported")])


def numeric_features(df: DataFrame, drop: list[str]) -> list[str]:
    skip = set(drop) | set(STRING_FEATURES)
    return [
        f.name for f in df.schema.fields
        if f.name not in skip and f.dataType.typeName() in ("double", "integer", "long", "float")
    ]


def feature_stages(numeric: list[str], strings=STRING_FEATURES) -> list:
    """L1 (fitted part): unseen-level bucket + full one-hot, assembly, and
    removal of zero-variance columns."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in strings]
    ohe = OneHotEncoder(
        inputCols=[f"{c}__idx" for c in strings], outputCols=[f"{c}__ohe" for c in strings],
        dropLast=False, handleInvalid="keep",
    )
    asm = VectorAssembler(
        inputCols=numeric + [f"{c}__ohe" for c in strings], outputCol="features_all",
        handleInvalid="keep",
    )
    zv = VarianceThresholdSelector(
        featuresCol="features_all", outputCol="features", varianceThreshold=0.0)
    return idx + [ohe, asm, zv]


@dataclass
class TunedModel:
    model: PipelineModel
    params: dict
    cv_table: list  # rows: (params, mean, std, chosen), with the folds before the choice where raced
    preparation: PipelineModel | None = None


def _one_se(cv_model, grid, larger_is_better: bool, complexity) -> tuple[int, list]:
    """Simplest parameter set within one standard error of the best."""
    avg = list(cv_model.avgMetrics)
    std = list(getattr(cv_model, "stdMetrics", [0.0] * len(avg)))
    k = cv_model.getNumFolds()
    best = max(range(len(avg)), key=lambda i: avg[i] if larger_is_better else -avg[i])
    se = std[best] / math.sqrt(max(k, 1))
    ok = [i for i in range(len(avg))
          if (avg[i] >= avg[best] - se if larger_is_better else avg[i] <= avg[best] + se)]
    chosen = min(ok, key=lambda i: complexity(grid[i]))
    table = [({p.name: v for p, v in grid[i].items()}, avg[i], std[i], i == chosen) for i in range(len(avg))]
    return chosen, table


def _prepare(data: DataFrame, numeric: list[str], key: list[str], folds: int, strata: list[str] | None):
    """Feature stages fitted once (they see no label), and the written design with its folds."""
    from ..session import drop_stage, write_stage

    features = Pipeline(stages=feature_stages(numeric)).fit(data)
    keys = [F.col(c).alias(f"_key{i}") for i, c in enumerate(key)]
    plain = write_stage(features.transform(data).select("features", "label", *keys), "cv_rows")
    folded = stratified_folds(plain, [f"_key{i}" for i in range(len(key))], folds, strata)
    design = write_stage(folded.select("features", "label", "fold"), "cv_design")
    drop_stage(plain)
    return features, design


def _finish(features: PipelineModel, est, design: DataFrame, params: dict, table: list) -> TunedModel:
    """Refit on all training rows."""
    final = est.copy({est.getParam(name): value for name, value in params.items()}).fit(design)
    return TunedModel(PipelineModel(stages=[*features.stages, final]), params, table)


def _cross_validate(prepared, est, evaluator, grid, folds, larger, parallelism) -> TunedModel:
    features, design = prepared
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=grid, evaluator=evaluator,
        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=7,
    )
    simplest = lambda pm: tuple(v for _, v in sorted((p.name, v) for p, v in pm.items()))
    chosen, table = _one_se(cv.fit(design), grid, larger, simplest)
    return _finish(features, est, design, {p.name: v for p, v in grid[chosen].items()}, table)


# ---- tuning of all parameters by racing (L5) -----------------------------------------------
#: Parameters of the boosted trees with their range and scale, in the order in which a
#: simpler model is preferred; ``mtry`` is a share of the features.
TUNED_PARAMETERS = {
    "mtry": (0.1, 1.0, "linear"),
    "maxIter": (5, 20, "whole"),
    "minInstancesPerNode": (2, 40, "whole"),
    "maxDepth": (2, 6, "whole"),
    "stepSize": (0.03, 0.3, "log"),
    "minInfoGain": (1e-10, 1e-2, "log"),
    "subsamplingRate": (0.5, 1.0, "linear"),
}
#: One-sided 95 % points of Student's t for 1 to 9 degrees of freedom (fixed values).
T_95 = [6.314, 2.920, 2.353, 2.132, 2.015, 1.943, 1.895, 1.860, 1.833]


def space_filling(n: int, ranges: dict = TUNED_PARAMETERS, seed: int = 400, draws: int = 200) -> list[dict]:
    """``n`` parameter sets: the Latin hypercube with the widest closest pair among ``draws``."""
    rng = np.random.default_rng(seed)
    best, widest = None, -1.0
    for _ in range(draws):
        unit = (np.stack([rng.permutation(n) for _ in ranges], axis=1) + rng.random((n, len(ranges)))) / n
        gaps = np.linalg.norm(unit[:, None] - unit[None], axis=2) + 9 * np.eye(n)
        if gaps.min() > widest:
            best, widest = unit, gaps.min()
    out = []
    for row in best:
        point = {}
        for u, (name, (low, high, scale)) in zip(row, ranges.items()):
            x = low * (high / low) ** u if scale == "log" else low + u * (high - low)
            point[name] = int(round(x)) if scale == "whole" else float(f"{x:.6g}")
        out.append(point)
    return out


def estimator_params(point: dict, n_features: int) -> dict:
    """A parameter set as the estimator takes it."""
    out = {k: v for k, v in point.items() if k != "mtry"}
    if "mtry" in point:
        out["featureSubsetStrategy"] = str(max(1, round(point["mtry"] * n_features)))
    return out


def beaten(scores: dict[int, list[float]], larger: bool) -> set[int]:
    """Parameter sets that a paired one-sided t-test at 95 % finds worse than the best mean so far."""
    sign = 1 if larger else -1
    best = max(scores, key=lambda i: sign * np.mean(scores[i]))
    out = set()
    for i, mine in scores.items():
        short = sign * (np.array(scores[best]) - np.array(mine))
        n = len(short)
        if i == best or n < 2:
            continue
        t = T_95[n - 2] if n - 2 < len(T_95) else 1.645
        if short.mean() > t * short.std(ddof=1) / math.sqrt(n):
            out.add(i)
    return out


def race(design: DataFrame, est, evaluator, points: list[dict], folds: int, larger: bool, burn_in: int = 3, parallelism: int = 4) -> tuple[dict, list]:
    """The parameter set of the one-standard-error rule, and a row (params, mean, sd, folds, chosen) for each.

    Every set is fitted on the first ``burn_in`` folds; after that, those that
    ``beaten`` names are dropped before the next fold.  The rule prefers, among
    the sets that ran all folds and lie within one standard error of the best
    one, the first in the order of ``TUNED_PARAMETERS``.
    """
    n_features = len(design.select("features").first()[0])
    scores: dict[int, list[float]] = {i: [] for i in range(len(points))}
    alive = set(scores)

    def one(at: tuple[int, int]) -> float:
        i, fold = at
        params = {est.getParam(k): v for k, v in estimator_params(points[i], n_features).items()}
        model = est.copy(params).fit(design.where(F.col("fold") != fold))
        return float(evaluator.evaluate(model.transform(design.where(F.col("fold") == fold))))

    first = max(1, min(burn_in, folds))  # nothing is dropped before, so these folds are fitted side by side
    with ThreadPoolExecutor(parallelism) as pool:
        for run in [range(first), *[[fold] for fold in range(first, folds)]]:
            order = [(i, fold) for fold in run for i in sorted(alive)]
            for (i, _), score in zip(order, pool.map(inheritable_thread_target(design.sparkSession)(one), order)):
                scores[i].append(score)
            if run[-1] + 1 < folds:
                alive -= beaten({i: scores[i] for i in alive}, larger)
    sign = 1 if larger else -1
    mean = {i: float(np.mean(s)) for i, s in scores.items()}
    spread = {i: float(np.std(s, ddof=1)) if len(s) > 1 else 0.0 for i, s in scores.items()}
    best = max(alive, key=lambda i: sign * mean[i])
    near = [i for i in alive if sign * (mean[best] - mean[i]) <= spread[best] / math.sqrt(folds)]
    chosen = min(near, key=lambda i: tuple(points[i][name] for name in TUNED_PARAMETERS if name in points[i]))
    return points[chosen], [(points[i], mean[i], spread[i], len(scores[i]), i == chosen) for i in range(len(points))]


# ---- the two models ------------------------------------------------------------------------
#: Parameters of the registered fits unless others are given; tuning (``tune_status_model``, ``tune_cases_model``) is a step of its own.
STATUS_PARAMS = {"mtry": 1.0, "maxIter": 10, "minInstancesPerNode": 2, "maxDepth": 5, "stepSize": 0.1, "minInfoGain": 1e-10, "subsamplingRate": 1.0}
CASES_PARAMS = dict(STATUS_PARAMS)


def _status_rows(train: DataFrame) -> DataFrame:
    data = recipe_columns(train.where(F.col("disease_status").isNotNull()))
    return data.withColumn("label", F.col("disease_status").cast("double"))


def _cases_rows(train: DataFrame) -> DataFrame:
    return recipe_columns(cases_training_rows(train)).withColumn(
        "label", F.log10(F.when(F.col("cases") == 0, F.lit(0.1)).otherwise(F.col("cases").cast("double"))))


def _status_model(seed: int):
    return GBTClassifier(labelCol="label", featuresCol="features", seed=seed), BinaryClassificationEvaluator(
        labelCol="label", metricName="areaUnderROC")


def _cases_model(seed: int):
    return GBTRegressor(labelCol="label", featuresCol="features", seed=seed), RegressionEvaluator(labelCol="label", metricName="rmse")


def _grid(est, max_iters, depths):
    return ParamGridBuilder().addGrid(est.maxIter, list(max_iters)).addGrid(est.maxDepth, list(depths)).build()


def fit_status_model(
    train: DataFrame, key: list[str], folds: int = 10, max_iters=(10,), depths=(3, 5),
    parallelism: int = 4, seed: int = 42,
) -> TunedModel:
    """L2 + L4 + L5 + L6 on a given grid: boosted-tree status classifier, stratified folds, one-SE."""
    data = _status_rows(train)
    est, evaluator = _status_model(seed)
    prepared = _prepare(data, numeric_features(data, [*STATUS_DROP, "label"]), key, folds, ["label"])
    return _cross_validate(prepared, est, evaluator, _grid(est, max_iters, depths), folds, True, parallelism)


def tune_status_model(
    train: DataFrame, key: list[str], points: list[dict] | None = None, folds: int = 10, burn_in: int = 3, parallelism: int = 4, seed: int = 42,
) -> TunedModel:
    """L2 + L4 + L5 + L6: all parameters raced over a space-filling design, stratified folds."""
    data = _status_rows(train)
    est, evaluator = _status_model(seed)
    features, design = _prepare(data, numeric_features(data, [*STATUS_DROP, "label"]), key, folds, ["label"])
    chosen, table = race(design, est, evaluator, points or space_filling(10), folds, True, burn_in, parallelism)
    return _finish(features, est, design, estimator_params(chosen, len(design.select("features").first()[0])), table)


def fit_status(train: DataFrame, params: dict = STATUS_PARAMS, seed: int = 42) -> TunedModel:
    """L2 + L6: the status classifier with known parameters."""
    data = _status_rows(train)
    return _fit_known(data, numeric_features(data, [*STATUS_DROP, "label"]), _status_model(seed)[0], params)


def _fit_known(data: DataFrame, numeric: list[str], est, params: dict) -> TunedModel:
    from ..session import write_stage

    features = Pipeline(stages=feature_stages(numeric)).fit(data)
    design = write_stage(features.transform(data).select("features", "label"), "fit_design")
    return _finish(features, est, design, estimator_params(params, len(design.select("features").first()[0])), [])


def cases_training_rows(df: DataFrame) -> DataFrame:
    """L3 rows: known cases, and cases or last-period cases above zero."""
    return df.where(F.col("cases").isNotNull() & ((F.col("cases") > 0) | (F.col("cases_lag1") > 0)))


def fit_cases_model(
    train: DataFrame, key: list[str], folds: int = 10, max_iters=(10,), depths=(3, 5),
    parallelism: int = 4, seed: int = 42,
) -> TunedModel:
    """L3 + L4-L6 on a given grid: boosted-tree regression of log10 cases (0 -> 0.1)."""
    data = _cases_rows(train)
    est, evaluator = _cases_model(seed)
    prepared = _prepare(data, numeric_features(data, [*CASES_DROP, "label"]), key, folds, None)
    return _cross_validate(prepared, est, evaluator, _grid(est, max_iters, depths), folds, False, parallelism)


def tune_cases_model(
    train: DataFrame, key: list[str], points: list[dict] | None = None, folds: int = 10, burn_in: int = 3, parallelism: int = 4, seed: int = 42,
) -> TunedModel:
    """L3 + L4-L6: all parameters raced over a space-filling design."""
    data = _cases_rows(train)
    est, evaluator = _cases_model(seed)
    features, design = _prepare(data, numeric_features(data, [*CASES_DROP, "label"]), key, folds, None)
    chosen, table = race(design, est, evaluator, points or space_filling(10), folds, False, burn_in, parallelism)
    return _finish(features, est, design, estimator_params(chosen, len(design.select("features").first()[0])), table)


def fit_cases(train: DataFrame, params: dict = CASES_PARAMS, seed: int = 42) -> TunedModel:
    """L3 + L6: the cases regression with known parameters."""
    data = _cases_rows(train)
    return _fit_known(data, numeric_features(data, [*CASES_DROP, "label"]), _cases_model(seed)[0], params)


_GENERATED = ["features_all", "features", "rawPrediction", "probability", "prediction"]


def _drop_generated(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in _GENERATED or c.endswith(("__idx", "__ohe"))])


def hurdle_predict(status: TunedModel, cases: TunedModel, df: DataFrame, key: list[str]) -> DataFrame:
    """Status class, then cases = bround(10^pred) where the status is 1.

    Both fitted pipelines are applied in sequence to the same rows (the
    first model's working columns dropped in between), so there is no join.
    """
    # columns the recipe transforms or drops are carried as copies and restored
    kept = [c for c in df.columns if c in LOG_LAGS or c.endswith("_unreported")]
    prepared = recipe_columns(df.withColumns({f"__keep{i}": F.col(c) for i, c in enumerate(kept)}))
    s = status.model.transform(prepared).withColumns({
        "disease_status_predicted": F.col("prediction").cast("int"),
        "status_probability": vector_to_array("probability")[1],
    })
    c = cases.model.transform(_drop_generated(s)).withColumn("_log_cases", F.col("prediction"))
    c = _drop_generated(c).withColumns({k: F.col(f"__keep{i}") for i, k in enumerate(kept)})
    out = c.select(*df.columns, "disease_status_predicted", "status_probability", "_log_cases")
    return out.withColumn(
        "cases_predicted",
        F.when(F.col("disease_status_predicted") == 0, F.lit(0.0))
        .otherwise(F.bround(F.pow(F.lit(10.0), F.col("_log_cases")), 0)),
    ).drop("_log_cases")


def feature_importance(model: TunedModel, top: int = 12) -> list[tuple[str, float]]:
    """V8: gain importances zipped with the selected feature names (top-n)."""
    pm = model.model
    tree = pm.stages[-1]
    sel = pm.stages[-2]
    attrs = _feature_names(pm)
    names = [attrs[i] if i < len(attrs) else f"f{i}" for i in sel.selectedFeatures]
    imp = tree.featureImportances.toArray()
    pairs = sorted(zip(names, imp), key=lambda t: -t[1])
    return [(n, float(v)) for n, v in pairs[:top]]


#: Words of feature labels (fixed values).
LABEL_WORDS = {
    "lag1": "(6 months prior)", "lag2": "(12 months prior)", "lag3": "(18 months prior)", "gdp": "GDP", "iso3c": "",
    "sum border countries": "in border countries (previous 18 months)",
}


def feature_label(feature: str) -> str:
    """V8: a feature's name as text: its words, with periods written out."""
    text = feature.replace("cases_lag_sum_", "cases_sum_").replace("_", " ")
    for word, label in LABEL_WORDS.items():
        text = re.sub(rf"\b{word}\b", label, text)
    text = " ".join(text.split())
    return text[:1].upper() + text[1:]


def _feature_names(pm: PipelineModel) -> list[str]:
    asm = [s for s in pm.stages if isinstance(s, VectorAssembler)][0]
    idx = {s.getOutputCol(): s for s in pm.stages if hasattr(s, "labels") and hasattr(s, "getOutputCol")}
    names = []
    for c in asm.getInputCols():
        if c.endswith("__ohe"):
            base = c[: -len("__ohe")]
            labels = list(idx[f"{base}__idx"].labels) + ["__unseen__"]
            names += [f"{base}_{lab}" for lab in labels]
        else:
            names.append(c)
    return names


def partial_dependence(
    model: TunedModel, df: DataFrame, variable: str, values: list, by: list[str] | None = None,
) -> DataFrame:
    """V9: average predicted status probability with ``variable`` forced to each
    grid value, over all rows, per group of ``by``; ``effect`` is the distance
    from the group's mean over the grid.

    Every row is expanded to the grid and scored in one pass; the only shuffle
    is the map-side combined average.
    """
    by = by or []
    grid = df.withColumn("_value", F.explode(F.array(*[F.lit(v) for v in values])))
    grid = grid.withColumn(variable, F.col("_value").cast(df.schema[variable].dataType))
    keep = {f"_by{i}": F.col(c) for i, c in enumerate(by)}
    pred = model.model.transform(recipe_columns(grid.withColumns(keep)))
    means = pred.groupBy(*[F.col(k).alias(c) for k, c in zip(keep, by)], F.col("_value").alias("value")).agg(
        F.avg(vector_to_array("probability")[1]).alias("mean_probability"), F.count(F.lit(1)).alias("n"))
    centre = F.avg("mean_probability").over(Window.partitionBy(*by)) if by else F.lit(
        means.agg(F.avg("mean_probability")).scalar())
    return means.select(
        F.lit(variable).alias("variable"), *by, "value", "mean_probability",
        (F.col("mean_probability") - centre).alias("effect"), "n")


def recipe_predictors(model: TunedModel) -> list[str]:
    """Columns of the fitted recipe's predictors: its numeric features and strings."""
    strings = [s.getInputCol() for s in model.model.stages if isinstance(s, StringIndexerModel)]
    assembler = next(s for s in model.model.stages if isinstance(s, VectorAssembler))
    return [c for c in assembler.getInputCols() if not c.endswith("__ohe")] + strings


def permutation_importance(
    model: TunedModel, df: DataFrame, variables: list[str], key: list[str], label: str,
    rows: Column | None = None, seed: int = 5,
) -> DataFrame:
    """Loss with each variable permuted, over the rows that ``rows`` selects (all by default).

    (variable, n, acc, dropout_loss, loss_change): accuracy, the root mean square
    distance of the predicted probability from the label, and its change against
    the unpermuted rows, ``(none)``.

    One permutation of all rows: the row of rank r by one key hash gets the values
    of the row of rank r by another.  Ranks are exact and come without a window
    over all rows (``hash_rank``), so the result depends on the keys alone.
    """
    from ..session import drop_stage, write_stage

    base = df.where(F.col(label).isNotNull())
    base = write_stage(recipe_columns(base.where(rows) if rows is not None else base), "permutation_rows")
    donors = hash_rank(base.select(*dict.fromkeys([*key, *variables])), key, [], seed + 1, "_rank")
    both = hash_rank(base, key, [], seed, "_rank").join(
        donors.select("_rank", *[F.col(v).alias(f"_perm_{v}") for v in variables]), "_rank")
    both = write_stage(both, "permutation_pairs")
    drop_stage(base)
    versions = F.explode(F.array(*[F.lit(v) for v in ("(none)", *variables)]))
    wide = both.withColumn("variable", versions).withColumns(
        {v: F.when(F.col("variable") == v, F.col(f"_perm_{v}")).otherwise(F.col(v)) for v in variables})
    truth = F.col(label).cast("double")
    off = vector_to_array("probability")[1] - truth
    scored = model.model.transform(wide).groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == truth).cast("double")).alias("acc"),
        F.sqrt(F.avg(off * off)).alias("dropout_loss"))
    scored = write_stage(scored, "permutation_scores")  # a row per variable
    whole = scored.where("variable = '(none)'").select("dropout_loss").scalar()
    return scored.withColumn("loss_change", F.col("dropout_loss") - whole)


def level_grid(df: DataFrame, variable: str, levels: int) -> list[float]:
    """At most ``levels`` of a numeric variable's values, at equal steps of rank from its least to its greatest."""
    known = df.where(F.col(variable).isNotNull()).withColumn("_all", F.lit(0))
    values = known.groupBy("_all", F.col(variable).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = value_ranks(values, ["_all"], "_v", "_n", "profile_values")
    targets = F.array(*[F.floor(F.lit(i / max(1, levels - 1)) * (F.col("_total") - 1)) for i in range(levels)])
    held = ranked.where(F.exists(targets, lambda t: (t >= F.col("_lo")) & (t < F.col("_lo") + F.col("_n"))))
    return sorted(r["_v"] for r in held.select("_v").collect())


def profiles(model: TunedModel, df: DataFrame, grids: dict[str, list[float]], by: list[str]) -> DataFrame:
    """V9: (variable, by..., value, prediction, n): mean prediction with each variable forced to each of its values.

    All variables are expanded and scored in one pass over ``df``; predictions
    are probabilities of a classifier, cases (10^x) of the cases regression.
    """
    points = [(v, float(x)) for v, values in grids.items() for x in values]
    forced = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(x).alias("value")) for v, x in points]))
    wide = df.withColumns({f"_by{i}": F.col(c) for i, c in enumerate(by)}).withColumn("_at", forced)
    wide = wide.withColumns({
        v: F.when(F.col("_at.variable") == v, F.col("_at.value").cast(df.schema[v].dataType)).otherwise(F.col(v)) for v in grids})
    out = model.model.transform(recipe_columns(wide))
    score = vector_to_array("probability")[1] if "probability" in out.columns else F.pow(F.lit(10.0), F.col("prediction"))
    return out.groupBy(F.col("_at.variable").alias("variable"), *[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)], F.col("_at.value").alias("value")).agg(
        F.avg(score).alias("prediction"), F.count(F.lit(1)).alias("n"))


def presence_effects(profile: DataFrame, by: list[str]) -> DataFrame:
    """V9: prediction with a 0/1 variable absent, present, and their difference; groups without both are left out."""
    at = lambda x: F.max(F.when(F.col("value") == x, F.col("prediction")))
    wide = profile.groupBy("variable", *by).agg(at(0.0).alias("absent"), at(1.0).alias("present"))
    return wide.dropna().withColumn("difference", F.col("absent") - F.col("present"))


def range_effects(profile: DataFrame, by: list[str]) -> DataFrame:
    """V9: (max - min) / min of the prediction over a numeric variable's values; null where the least is 0."""
    least, most = F.min("prediction"), F.max("prediction")
    return profile.groupBy("variable", *by).agg(
        least.alias("least"), most.alias("most"), F.count(F.lit(1)).alias("n_values"),
        F.when(least != 0, (most - least) / least).alias("relative_range"))


# ---- persistence (A7) --------------------------------------------------------------------
def save_tuned(model: TunedModel, path: str, preparation: Model | None = None) -> None:
    """Save the fitted pipeline (any Hadoop URI) with its parameters, and the preparation of its rows."""
    import json

    from pyspark.sql import SparkSession

    model.model.write().overwrite().save(f"{path}/pipeline")
    if preparation is not None:
        PipelineModel(stages=[preparation]).write().overwrite().save(f"{path}/preparation")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"params": model.params, "prepared": preparation is not None})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/params")


def load_tuned(path: str) -> TunedModel:
    """A saved model; its ``preparation`` is the one it was saved with, or null."""
    import json

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/params").first()["value"])
    preparation = PipelineModel.load(f"{path}/preparation") if meta["prepared"] else None
    return TunedModel(PipelineModel.load(f"{path}/pipeline"), meta["params"], [], preparation)
