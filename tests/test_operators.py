"""Hand fixtures for the null / numeric semantics and operator properties."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.exprs import clean_name, control_flag_columns, parse_int_text
from panelcast.operators import covariates as cov
from panelcast.operators import links, panel, rollup, scoring, spatial, splits, threads

D = dt.date


def test_parse_int_text(spark):
    df = spark.createDataFrame([("12",), ("12.7",), ("na",), (None,), ("-3",)], "cases string")
    got = [r[0] for r in df.select(parse_int_text("cases")).collect()]
    assert got == [12, 12, None, None, -3]


def test_clean_name(spark):
    df = spark.createDataFrame(
        [("Brand#1",), ("4-NOT SPECIFIED",), ("fooBar  baz",), ("Équipe 50%",), ("__",)], "s string")
    got = [r[0] for r in df.select(clean_name("s")).collect()]
    assert got == ["brand_number_1", "x4_not_specified", "foo_bar_baz", "equipe_50_percent", "x"]


REPORT_SCHEMA = (
    "country_iso3c string, report_year int, report_semester int, disease string, "
    "disease_population string, taxa string, serotype string, control_measures string, "
    "disease_status string, cases string"
)


def test_rollup_semantics(spark):
    rows = [
        # pair present/absent + cases "12" and "12.7" -> 24; measures union, "na" ignored
        ("abc", 2005, 1, "d", "dom", "goats", "1", "zoning; stamping out", "present", "12"),
        ("abc", 2005, 1, "d", "dom", "sheep", "2", "na", "absent", "12.7"),
        ("abc", 2005, 1, "d", "dom", "sheep (mixed herd)", "3", None, None, None),
        # triple -> present; all-null cases -> null; duplicates collapse
        ("abc", 2005, 2, "d", "dom", "cattle", "1", "zoning", "absent", None),
        ("abc", 2005, 2, "d", "dom", "cattle", "2", "zoning; monitoring", "unreported", "x"),
        ("abc", 2005, 2, "d", "dom", "cattle", "3", None, "present", None),
        # unknown status only -> null; no measures -> "none"
        ("abc", 2006, 1, "d", "dom", "swine", "1", None, "weird", "5"),
        # dropped taxa and null country
        ("abc", 2006, 1, "d", "dom", "dogs", "1", None, "present", "1"),
        (None, 2006, 1, "d", "dom", "swine", "1", None, "present", "1"),
    ]
    df = spark.createDataFrame(rows, REPORT_SCHEMA)
    out = {(r.report_year, r.report_semester, r.taxa): r for r in rollup.rollup_reports(df).collect()}
    assert len(out) == 3
    a = out[(2005, 1, "sheep/goats")]
    assert a.country_iso3c == "ABC" and a.cases == 24 and a.disease_status == "present"
    assert a.control_measures == "stamping out; zoning"
    b = out[(2005, 2, "cattle")]
    assert b.cases is None and b.disease_status == "present"
    assert b.control_measures == "monitoring; zoning"
    c = out[(2006, 1, "swine")]
    assert c.disease_status is None and c.control_measures == "none" and c.cases == 5


def test_control_flags_substring(spark):
    df = spark.createDataFrame([("modified stamping out; zoning",), (None,)], "t string")
    r = df.select(*[c.alias(n) for n, c in control_flag_columns("t").items()]).collect()
    assert r[0]["control_stamping_out"] == 1 and r[0]["control_modified_stamping_out"] == 1
    assert r[0]["control_zoning"] == 1 and r[0]["control_screening"] == 0
    assert all(v == 0 for v in r[1].asDict().values())


def test_ever_before(spark):
    rows = [("a", 1, 1), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 0),
            (None, 1, 0), (None, 2, 1), (None, 3, 0)]
    df = spark.createDataFrame(rows, "g string, p int, f int")
    got = {(r.g, r.p): r.ever for r in panel.ever_before(df, ["g"], "p", F.col("f") == 1, "ever").collect()}
    assert [got[("a", i)] for i in (1, 2, 3)] == [0, 1, 1]
    assert [got[("b", i)] for i in (1, 2)] == [0, 0]
    assert [got[(None, i)] for i in (1, 2, 3)] == [0, 0, 1]


def test_dense_grid_and_lags(spark):
    facts = spark.createDataFrame(
        [("e", "X", 10, 5), ("e", "X", 12, 7), ("e", "Y", 11, 1)], "ent string, reg string, p int, v int")
    g = panel.dense_grid(facts, ["ent"], "reg", "p", 10, 12)
    assert g.count() == 6
    lag = panel.panel_lag(g, ["ent", "reg"], "p", ["v"], 2)
    rows = {(r.reg, r.p): r for r in lag.collect()}
    assert rows[("X", 12)].v_lag1 is None and rows[("X", 12)].v_lag2 == 5
    assert rows[("X", 11)]._observed is False


def test_prepvar(spark):
    df = spark.createDataFrame([(None,), (float("inf"),), (0.0,), (10.0,), (100.0,)], "x double")
    st = cov.prepvar_fit_many(df, {"v": (F.col("x"), lambda c: c, "auto")})["v"]
    # regular (non-zero finite) values 10, 100: min 10, sd 63.64
    sd = np.std([10.0, 100.0], ddof=1)
    assert st.na_fill == pytest.approx(10 - 6 * sd)
    assert st.zero_fill == pytest.approx(10 - 3 * sd)
    out = [r[0] for r in df.select(cov.prepvar_apply(F.col("x"), st, lambda c: c, "auto", "auto")).collect()]
    assert out[0] == pytest.approx(10 - 6 * sd) and out[1] == pytest.approx(10 - 6 * sd)
    assert out[2] == pytest.approx(10 - 3 * sd) and out[3:] == [10.0, 100.0]
    one = spark.createDataFrame([(5.0,), (None,)], "x double")
    st1 = cov.prepvar_fit_many(one, {"v": (F.col("x"), lambda c: c, "zero")})["v"]
    assert st1.na_fill is None  # sd of one value is undefined


EVENT_SCHEMA = (
    "report_id string, outbreak_thread_id long, country_iso3c string, disease string, "
    "is_aquatic boolean, report_date date, date_of_start_of_the_event date, date_event_resolved date"
)


def test_thread_bounds(spark):
    as_of = D(2021, 8, 1)
    rows = [
        ("r1", 1, "AAA", "d", False, D(2020, 3, 15), None, None),               # missing start, old, unresolved
        ("r2", 1, "AAA", "d", False, D(2020, 5, 2), D(2020, 1, 20), None),
        ("r3", 2, "AAA", "d", False, D(2021, 2, 1), D(2021, 1, 5), None),        # recent unresolved -> open
        ("r4", 3, "AAA", "d", False, D(2019, 6, 1), D(2019, 6, 1), D(2019, 3, 1)),  # resolved before report
        ("r5", None, "AAA", "d", False, D(2018, 1, 9), None, D(2018, 2, 1)),     # no thread id
        ("r6", 4, "AAA", "d", None, D(2018, 1, 9), None, None),                  # aquatic unknown -> dropped
        ("r7", 5, "NA", "d", False, D(2018, 1, 9), None, None),                  # country "NA" -> dropped
    ]
    b = {r.outbreak_thread_id: r for r in threads.thread_bounds(spark.createDataFrame(rows, EVENT_SCHEMA), as_of).collect()}
    assert set(b) == {1, 2, 3, None}
    assert b[1].outbreak_start_month == D(2020, 1, 1) and b[1].outbreak_end_month == D(2020, 5, 1)
    assert b[2].outbreak_end_month > D(2100, 1, 1)
    # end = latest of (resolved else report) month: here the resolution precedes the report
    assert b[3].outbreak_start_month == D(2019, 6, 1) and b[3].outbreak_end_month == D(2019, 3, 1)
    cells = threads.thread_cell_flags(
        spark.createDataFrame([r for r in b.values() if r.outbreak_thread_id == 3]), D(2015, 1, 1), as_of)
    c = cells.collect()
    assert len(c) == 1 and c[0].outbreak_start and not c[0].outbreak_subsequent_month
    assert b[None].outbreak_start_month == D(2018, 1, 1) and b[None].outbreak_end_month == D(2018, 2, 1)


def test_import_pressure_equals_naive_pairs(spark):
    presence = spark.createDataFrame(
        [("A", "d", D(2020, 1, 1)), ("B", "d", D(2020, 1, 1)), ("C", "d", D(2020, 2, 1)),
         ("D", "d", D(2020, 1, 1))], "country_origin string, disease string, month date")
    static = spark.createDataFrame(
        [("A", "B", 1.0, 2.0), ("B", "A", 1.0, 3.0), ("A", "A", 1.0, 9.0), ("C", "B", 0.0, 1.0)],
        "country_origin string, country_destination string, shared_borders_from_outbreaks double, "
        "n_migratory_wildlife_from_outbreaks double")
    yearly = spark.createDataFrame(
        [("A", "B", 2020, 100.0, 7.0), ("A", "C", 2019, 50.0, 1.0), ("D", "B", 2020, 5.0, None)],
        "country_origin string, country_destination string, year int, ots_trade_dollars_from_outbreaks double, "
        "fao_livestock_heads_from_outbreaks double")
    got = {(r.country_iso3c, r.month): r for r in links.import_pressure(presence, static, yearly).collect()}
    # naive: every destination x every present origin (not itself), summing linked values
    pres = [r.asDict() for r in presence.collect()]
    st = {(r[0], r[1]): r for r in static.collect()}
    yr = {(r[0], r[1], r[2]): r for r in yearly.collect()}
    for dest in "ABCD":
        for m in (D(2020, 1, 1), D(2020, 2, 1)):
            origins = [p["country_origin"] for p in pres if p["month"] == m and p["country_origin"] != dest]
            sb = sum(st[(o, dest)][2] for o in origins if (o, dest) in st)
            tr = sum(yr[(o, dest, m.year)][3] for o in origins if (o, dest, m.year) in yr)
            row = got.get((dest, m))
            assert (row.shared_borders_from_outbreaks or 0) == sb if row else sb == 0
            assert (row.ots_trade_dollars_from_outbreaks or 0) == tr if row else tr == 0


def test_splits_properties(spark):
    grid = spark.range(0, 40).select(
        (F.col("id") % 4).cast("string").alias("k"), (F.col("id") / 4).cast("int").alias("p"))
    s1 = splits.split_adjacent_pairs(grid, ["k"], "p", 0.1, seed=3).toPandas()
    for _, g in s1.groupby("k"):
        sel = set(g.loc[g.validation_set, "p"])
        assert math.ceil(0.1 * len(g)) <= len(sel) <= 2 * math.ceil(0.1 * len(g))
        assert all((p + 1 in sel) or (p - 1 in sel) for p in sel)
    s2 = splits.split_sample(grid, ["k"], "p", 0.2, seed=3).toPandas()
    assert (s2.groupby("k").validation_set.sum() == 2).all()


def test_enclosing_radius_geometry():
    r = spatial.enclosing_radius
    assert r(np.array([[1.0, 1.0]])) == 0.0
    assert r(np.array([[0.0, 0.0], [6.0, 8.0], [0.0, 0.0]])) == pytest.approx(5.0)
    assert r(np.array([[0.0, 0.0], [1.0, 0.0], [4.0, 0.0]])) == pytest.approx(2.0)
    assert r(np.array([[0.0, 0.0], [10.0, 0.0], [5.0, 1.0]])) == pytest.approx(5.0)  # obtuse
    eq = np.array([[0.0, 0.0], [2.0, 0.0], [1.0, math.sqrt(3)]])
    assert r(eq) == pytest.approx(2 / math.sqrt(3))
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(500, 2))
    h = spatial.convex_hull(pts)
    assert r(h) == pytest.approx(r(pts))


def test_bounding_radius_distributed_matches_local(spark):
    rows = [("g1", 10.0, 20.0), ("g1", 10.5, 20.5), ("g1", 11.0, 19.0), ("g2", -5.0, 100.0)]
    df = spark.createDataFrame(rows, "k string, latitude double, longitude double")
    out = {r.k: r.outbreak_radius for r in spatial.bounding_radius(df, ["k"], points_per_task=2).collect()}
    assert out["g2"] == 0.0
    assert 50_000 < out["g1"] < 150_000  # ~1.1 degrees across, in metres


def test_class_metrics_binary(spark):
    cm = spark.createDataFrame(
        [("m", "0", "0", 50), ("m", "0", "1", 10), ("m", "1", "0", 5), ("m", "1", "1", 35)],
        "model string, truth string, estimate string, n long")
    got = {r.metric: r.estimate for r in scoring.class_metrics(cm, ["model"]).collect()}
    po, pe = 0.85, (60 * 55 + 40 * 45) / 100 ** 2
    assert got["accuracy"] == pytest.approx(po)
    assert got["kap"] == pytest.approx((po - pe) / (1 - pe))
    assert got["sens"] == pytest.approx(50 / 60) and got["spec"] == pytest.approx(35 / 40)


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0]


def test_mixed_logit_recovers_slopes(spark):
    from panelcast.operators.mixed import fit_mixed_logit

    rng = np.random.default_rng(7)
    groups = [f"g{i}" for i in range(8)]
    true = {g: rng.normal(0, 1.0, size=2) for g in groups}
    rows = []
    for g in groups:
        x = rng.normal(size=(600, 2))
        p = 1 / (1 + np.exp(-(-0.5 + x @ true[g])))
        y = rng.random(600) < p
        rows += [(g, bool(yy), float(a), float(b), 1) for yy, (a, b) in zip(y, x)]
    df = spark.createDataFrame(rows, "disease string, y boolean, x1 double, x2 double, count long")
    fit = fit_mixed_logit(df, ["x1", "x2"], "y", "disease", "count")
    assert fit.converged
    slopes = {r.disease: r.u for r in fit.slope_frame.collect()}
    est = np.array([slopes[g] for g in groups]).ravel()
    tru = np.array([true[g] for g in groups]).ravel()
    assert np.corrcoef(est, tru)[0, 1] > 0.95
    assert abs(fit.intercept + 0.5) < 0.3
    assert fit.aic() > 0


def test_mixed_logit_block_and_constant_predictor(spark):
    """A correlated block is recovered; a constant predictor gets slope and variance 0."""
    from panelcast.operators.mixed import fit_mixed_logit, predict

    rng = np.random.default_rng(11)
    cov = np.array([[1.0, 0.8], [0.8, 1.0]])
    rows = []
    for g in range(40):
        u = rng.multivariate_normal([0, 0], cov)
        x = rng.normal(size=(250, 2))
        p = 1 / (1 + np.exp(-(-0.3 + x @ u)))
        rows += [(f"g{g}", bool(rng.random() < q), float(a), float(b), 2.0, 1) for q, (a, b) in zip(p, x)]
    df = spark.createDataFrame(rows, "disease string, y boolean, a double, b double, c double, count long")
    fit = fit_mixed_logit(df, ["a", "b", "c"], "y", "disease", "count", block=["a", "b"])
    assert fit.converged and fit.constant == ["c"] and fit.covariance[2, 2] == 0
    corr = fit.covariance[0, 1] / np.sqrt(fit.covariance[0, 0] * fit.covariance[1, 1])
    assert 0.5 < corr < 0.97 and fit.n_params == 1 + 1 + 3
    out = predict(df, fit)
    assert out.count() == len(rows) and out.where("predicted_outbreak_probability is null").count() == 0


def test_bounding_radius_by_group_size(spark):
    """0 for one point, half the distance for two, the enclosing circle beyond; hot groups by hulls."""
    from panelcast.operators.spatial import bounding_radius

    rows = [("one", 10.0, 20.0), ("one", 10.0, 20.0), ("two", 50.0, 8.0), ("two", 50.1, 8.0)]
    rows += [("ring", 45 + 0.1 * np.sin(t), 9 + 0.1 * np.cos(t) / np.cos(np.radians(45))) for t in np.linspace(0, 6.28, 50)]
    df = spark.createDataFrame([(k, float(a), float(b)) for k, a, b in rows], "k string, latitude double, longitude double")
    for per_task in (200_000, 7):
        got = {r.k: r.outbreak_radius for r in bounding_radius(df, ["k"], points_per_task=per_task).collect()}
        assert got["one"] == 0.0
        assert abs(got["two"] - 0.05 * 111_229) < 30  # 0.1 degree of latitude at 50 N
        assert abs(got["ring"] - 11_120) < 60


def test_calibration_edges_are_exact(spark):
    from panelcast.operators.scoring import calibration_bins

    rng = np.random.default_rng(5)
    p = np.round(rng.random(997), 2)
    df = spark.createDataFrame([(float(x), bool(rng.random() < x), "g" if i % 3 else None) for i, x in enumerate(p)],
                               "p double, y boolean, g string").repartition(5)
    got = sorted((r.bin, r.n, r.pred_min, r.pred_max) for r in calibration_bins(df, "p", "y", 10).collect())
    s = np.sort(p)
    edges = sorted({s[int(np.ceil(i / 10 * len(s))) - 1] for i in range(1, 10)})
    bins = np.searchsorted(edges, p, side="left")
    assert got == [(b, int((bins == b).sum()), p[bins == b].min(), p[bins == b].max()) for b in sorted(set(bins))]
    by = calibration_bins(df, "p", "y", 3, ["g"]).groupBy("g").agg(F.sum("n").alias("n")).collect()
    assert {r.g: r.n for r in by} == {"g": sum(i % 3 > 0 for i in range(997)), None: 333}


def test_bootstrap_depends_on_keys_only(spark):
    from panelcast.operators.splits import bootstrap

    df = spark.range(4000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in bootstrap(df, ["k"], 3).collect())
    assert a == sorted(r.k for r in bootstrap(df.repartition(13), ["k"], 3).collect())
    assert 3700 < len(a) < 4300 and len(set(a)) < 2700


def test_cross_validation_with_more_folds(spark):
    """Five folds are run (the default of the tuner is three)."""
    from panelcast.operators import models

    rng = np.random.default_rng(1)
    rows = [(i, "d", "t", f"c{i % 3}", "x", "p", 1 + i % 2, 2000, int(rng.random() < 0.5), float(rng.random())) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, disease string, taxa string, country_iso3c string, continent string, "
                                     "disease_population string, report_semester int, report_year int, disease_status int, v double")
    fit = models.fit_status_model(df, ["id"], folds=5, max_iters=(2,), depths=(2,), parallelism=1)
    assert len(fit.cv_table) == 1 and 0 <= fit.cv_table[0][1] <= 1
