"""Fit-once preparation, saved models and declared checks."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from panelcast.operators import checks, models
from panelcast.operators.preparation import Prepvar

ROWS = [(1, 100.0), (2, 10.0), (3, 1000.0), (4, 0.0), (5, None), (6, float("inf"))]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "id int, v double")


def estimator(**extra):
    return Prepvar(variables={"log_v": {"x": "v", "transform": "log10", "zero": "auto", **extra}}, drop=["v"])


def test_fills_come_from_the_fitting_rows_only(spark, frame):
    model = estimator().fit(frame)
    sd = np.std([2, 1, 3], ddof=1)
    got = {r["id"]: r["log_v"] for r in model.transform(frame).collect()}
    assert got == pytest.approx({1: 2, 2: 1, 3: 3, 4: 1 - 3 * sd, 5: 1 - 6 * sd, 6: 1 - 6 * sd})
    forecast = spark.createDataFrame([(9, 0.001), (10, None)], "id int, v double")
    later = {r["id"]: r["log_v"] for r in model.transform(forecast).collect()}
    assert later == pytest.approx({9: -3, 10: 1 - 6 * sd})  # not -3 - 6 sd
    assert model.transform(forecast).columns == ["id", "log_v"]


def test_scaling_is_part_of_the_model(frame):
    model = estimator(scale=True, na=0.0).fit(frame)
    x = np.array([r["log_v"] for r in model.transform(frame).collect()])
    assert abs(x.mean()) < 1e-12 and abs(x.std(ddof=1) - 1) < 1e-12
    constant = Prepvar(variables={"c": {"x": "id * 0 + 7", "scale": True}}).fit(frame)
    assert {r["c"] for r in constant.transform(frame).collect()} == {0.0}


def test_saved_in_a_pipeline_and_loaded(frame, tmp_path):
    fitted = Pipeline(stages=[estimator(scale=True)]).fit(frame)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    back = PipelineModel.load(str(tmp_path / "p"))
    assert back.transform(frame).collect() == fitted.transform(frame).collect()
    estimator().write().overwrite().save(str(tmp_path / "e"))
    assert Prepvar.load(str(tmp_path / "e")).fit(frame).transform(frame).collect() == estimator().fit(frame).transform(frame).collect()


def test_unknown_options_and_empty_frames(frame):
    with pytest.raises(ValueError):
        Prepvar(variables={"a": {"x": "v", "fill": 1}}).fit(frame)
    empty = estimator().fit(frame.limit(0))
    got = {r["id"]: r["log_v"] for r in empty.transform(frame).collect()}
    assert got[1] == 2 and got[5] is None and got[4] is None  # nothing to fill with


def test_tuned_model_keeps_its_preparation(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, "d", "t", f"c{i % 3}", "x", "p", 1 + i % 2, 2000, int(rng.random() < 0.5), float(i % 40)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, disease string, taxa string, country_iso3c string, continent string, disease_population string, "
                                     "report_semester int, report_year int, disease_status int, v double")
    preparation = Prepvar(variables={"log_v": {"x": "v", "transform": "log10"}}, drop=["v"]).fit(df)
    model = models.fit_status(preparation.transform(df), {"maxIter": 2, "maxDepth": 2})
    models.save_tuned(model, str(tmp_path / "m"), preparation)
    back = models.load_tuned(str(tmp_path / "m"))
    assert back.params == model.params
    score = lambda m, prep: [r[0] for r in m.model.transform(models.recipe_columns(prep.transform(df))).orderBy("id").select("prediction").collect()]
    assert score(back, back.preparation) == score(model, preparation)
    models.save_tuned(model, str(tmp_path / "n"))
    assert models.load_tuned(str(tmp_path / "n")).preparation is None


SCHEMA = checks.TableSchema(required=["k", "s", "x"], key=["k"], not_null=["k", "x"], categories={"s": ["a", "b"]}, ranges={"x": (0, 10)})


def test_a_fitting_table_is_written(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 10.0)], "k int, s string, x double")
    assert sorted(map(tuple, checks.checked_stage(df, SCHEMA, "good").collect())) == [(1, "a", 1.0), (2, None, 10.0)]
    assert checks.checked_stage(df.limit(0), SCHEMA, "empty").count() == 0


def test_problems_raise_together_by_name(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "z", None), (2, "b", -1.0), (3, "q", 11.0)], "k int, s string, x double")
    with pytest.raises(checks.CheckError) as e:
        checks.checked_stage(df, SCHEMA, "bad")
    assert e.value.problems == {"null x": 1, "category of s": 2, "range of x": 2, "repeated key (k)": 1} and "bad" in str(e.value)
    with pytest.raises(checks.CheckError, match="missing columns: s, x"):
        checks.checked_stage(df.select("k"), SCHEMA, "narrow")


def test_null_report(spark):
    df = spark.createDataFrame([("p", None, 1), ("p", None, None), ("q", 1, 1)], "g string, a int, b int")
    assert {tuple(r) for r in checks.null_report(df, ["a", "b"], ["g"]).collect()} == {("p", "a", 2), ("p", "b", 1)}
    assert {tuple(r) for r in checks.null_report(df, ["a"]).collect()} == {("a", 2)}
    assert math.isclose(checks.duplicate_count(df, ["g"]), 1)
    assert df.select(F.lit(1)).count() == 3
