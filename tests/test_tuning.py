"""Tuning by racing, profiles and permutation on a small panel."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import models


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1200):
        lag, v = int(rng.random() < 0.4), float(rng.normal())
        y = int(rng.random() < (0.85 if lag else 0.1))
        rows.append((i, f"d{i % 3}", "t", f"c{i % 4}", "x", "p", 1 + i % 2, 2000, y, float(rng.integers(0, 40)), lag, float(lag * 10), v))
    df = spark.createDataFrame(rows, "id int, disease string, taxa string, country_iso3c string, continent string, disease_population string, "
                                     "report_semester int, report_year int, disease_status int, cases double, disease_status_lag1 int, "
                                     "cases_lag1 double, v double")
    df.cache().count()
    return df


@pytest.fixture(scope="module")
def status(panel):
    return models.fit_status(panel, {**models.STATUS_PARAMS, "maxIter": 4, "maxDepth": 3})


def test_space_filling_design_is_a_latin_hypercube():
    points = models.space_filling(8)
    assert points == models.space_filling(8) and len(points) == 8
    for name, (low, high, scale) in models.TUNED_PARAMETERS.items():
        x = np.array([p[name] for p in points], dtype=float)
        assert x.min() >= low and x.max() <= high
        if scale != "whole":
            unit = (np.log(x) - np.log(low)) / (np.log(high) - np.log(low)) if scale == "log" else (x - low) / (high - low)
            assert sorted(np.floor(unit * 8 - 1e-9).astype(int)) == list(range(8))


def test_beaten_sets_are_clearly_worse():
    best, near, worse = [0.9, 0.91, 0.89], [0.9, 0.92, 0.87], [0.7, 0.72, 0.69]
    assert models.beaten({0: best, 1: near, 2: worse}, True) == {2}
    assert models.beaten({0: best, 1: near, 2: worse}, False) == {0, 1}
    assert models.beaten({0: [0.9], 1: [0.1]}, True) == set()


def test_race_drops_the_losers_and_prefers_the_simpler(panel):
    base = {"mtry": 1.0, "minInstancesPerNode": 2, "minInfoGain": 1e-10, "subsamplingRate": 1.0, "maxIter": 3}
    points = [{**base, "maxDepth": 3, "stepSize": 0.3}, {**base, "maxDepth": 2, "stepSize": 0.3},
              {**base, "minInstancesPerNode": 1100, "maxDepth": 2, "stepSize": 0.1}]
    tuned = models.tune_status_model(panel, ["id"], points, folds=5, burn_in=2)
    folds = [row[3] for row in tuned.cv_table]
    assert folds[2] == 2 and max(folds) == 5  # a tree without splits is dropped after the burn-in
    assert [row[4] for row in tuned.cv_table].count(True) == 1 and not tuned.cv_table[2][4]
    assert 0.8 < max(row[1] for row in tuned.cv_table) <= 1
    assert set(tuned.params) == {*models.TUNED_PARAMETERS} - {"mtry"} | {"featureSubsetStrategy"}


def test_race_fits_the_burn_in_folds_side_by_side(spark):
    """Two sets on two burn-in folds are four fits at a time: each waits for the other three."""
    together, fitted = threading.Barrier(4), []

    class Fit:
        def getParam(self, name):
            return name

        def copy(self, params):
            self_ = Fit()
            self_.maxDepth = params["maxDepth"]
            return self_

        def fit(self, rows):
            left_out = ({0, 1, 2} - {r["fold"] for r in rows.select("fold").distinct().collect()}).pop()
            fitted.append((left_out, self.maxDepth))
            if left_out < 2:
                together.wait(timeout=60)
            return self

        def transform(self, rows):
            return self.maxDepth, rows.first()["fold"]

    class Score:
        def evaluate(self, scored):
            depth, fold = scored
            return depth / 10 + fold / 100

    design = spark.createDataFrame([([1.0, 2.0], i % 3) for i in range(9)], "features array<double>, fold int")
    chosen, table = models.race(design, Fit(), Score(), [{"maxDepth": 3}, {"maxDepth": 5}], 3, True, burn_in=2, parallelism=4)
    assert chosen == {"maxDepth": 5}
    # the scores differ by the same in both folds, so the smaller is beaten after the burn-in
    assert [(row[3], row[4]) for row in table] == [(2, False), (3, True)]
    assert sorted(fitted) == [(0, 3), (0, 5), (1, 3), (1, 5), (2, 5)]
    assert abs(table[0][1] - 0.305) < 1e-12 and abs(table[1][1] - 0.51) < 1e-12


def test_permutation_pairs_all_rows_once(panel, status):
    predictors = models.recipe_predictors(status)
    a, b = (
        {r["variable"]: (r["n"], round(r["acc"], 9), round(r["dropout_loss"], 9), round(r["loss_change"], 9)) for r in models.permutation_importance(
            status, part, predictors, ["id"], "disease_status").collect()}
        for part in (panel, panel.repartition(5)))
    assert a == b and set(a) == {"(none)", *predictors}
    assert a["(none)"][0] == 1200 and a["(none)"][3] == 0
    signal = max(a["disease_status_lag1"][3], a["cases_lag1"][3])
    assert signal > 0.05 > a["v"][3]


def test_profiles_match_scoring_by_hand(panel, status):
    grids = {"disease_status_lag1": [0.0, 1.0], "v": models.level_grid(panel, "v", 5)}
    assert len(grids["v"]) == 5 and grids["v"][0] == panel.agg(F.min("v")).first()[0]
    got = {(r["variable"], r["disease"], r["value"]): (r["prediction"], r["n"]) for r in models.profiles(status, panel, grids, ["disease"]).collect()}
    assert len(got) == 3 * 7
    for variable, x in [("disease_status_lag1", 1.0), ("v", grids["v"][2])]:
        forced = panel.withColumn(variable, F.lit(x).cast(panel.schema[variable].dataType)).withColumn("by", F.col("disease"))
        scored = status.model.transform(models.recipe_columns(forced))
        for r in scored.groupBy("by").agg(F.avg(models.vector_to_array("probability")[1]).alias("p"), F.count("by").alias("n")).collect():
            assert abs(got[variable, r["by"], x][0] - r["p"]) < 1e-12 and got[variable, r["by"], x][1] == r["n"]


def test_effects_of_profiles(spark):
    rows = [("s", "a", 0.0, 0.2), ("s", "a", 1.0, 0.7), ("s", "b", 0.0, 0.4), ("n", "a", 1.0, 2.0), ("n", "a", 2.0, 5.0), ("n", "b", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "variable string, disease string, value double, prediction double")
    got = models.presence_effects(df.where("variable = 's'"), ["disease"]).collect()
    assert [(r["disease"], r["absent"], r["present"]) for r in got] == [("a", 0.2, 0.7)] and abs(got[0]["difference"] + 0.5) < 1e-12
    spread = {r["disease"]: r["relative_range"] for r in models.range_effects(df.where("variable = 'n'"), ["disease"]).collect()}
    assert spread == {"a": 1.5, "b": None}
