"""Steps whose input is read once, and aggregates that do not sort their rows."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from panelcast.operators import mixed, rollup, spatial, threads


def _plan(df, executed=False):
    q = df._jdf.queryExecution()
    return (q.executedPlan() if executed else q.analyzed()).toString()


EVENTS = """report_id string, outbreak_thread_id long, country_iso3c string, disease string, is_aquatic boolean, report_date date,
date_of_start_of_the_event date, date_event_resolved date"""


def _events(spark):
    d = dt.date
    return spark.createDataFrame([
        ("a", 1, "X", "flu", False, d(2000, 1, 5), d(2000, 1, 2), None),
        ("b", 1, "X", "flu", False, d(2000, 2, 5), d(2000, 1, 2), d(2000, 3, 1)),
        ("c", 2, "X", "flu", False, d(2000, 1, 9), d(2000, 1, 2), d(2000, 3, 1)),
        ("d", None, "Y", "pox", False, d(2000, 2, 5), None, None),
        ("e", None, "Y", "pox", False, d(2000, 2, 5), None, None),
        ("f", 3, "Z", "flu", True, d(2000, 2, 5), None, None),
        ("g", 4, "Y", None, False, d(2000, 2, 5), None, None)], EVENTS)


def test_panel_from_spans_is_the_panel_from_events(spark):
    lo, hi = dt.date(2000, 1, 1), dt.date(2000, 4, 1)
    spans = threads.thread_spans(_events(spark), hi)
    assert spans.count() == 3  # equal spans of one pair are one row
    panel = threads.thread_month_panel(None, lo, hi, spans=spans).collect()
    assert sorted(map(str, panel)) == sorted(map(str, threads.thread_month_panel(_events(spark), lo, hi).collect()))
    assert len(panel) == 3 * 2 * 4
    flu = {r.month.month: r for r in panel if r.disease == "flu" and r.country_iso3c == "X"}
    assert flu[1].outbreak_start and flu[3].outbreak_subsequent_month and not flu[4].outbreak_ongoing


def test_roll_up_counts_rows_before_it_collects_lists(spark):
    rows = [("X", 2000, 1, "flu", "wild", "cattle", "present", "3", "a; b"), ("X", 2000, 1, "flu", "wild", "cattle", "absent", None, "b; c"),
            ("X", 2000, 1, "flu", "wild", "cattle", None, "4", "na"), ("X", 2000, 2, "flu", "wild", "cattle", "absent", None, None)]
    df = spark.createDataFrame(rows, "country_iso3c string, report_year int, report_semester int, disease string, disease_population string, "
                                     "taxa string, disease_status string, cases string, control_measures string")
    out = rollup.rollup_reports(df, taxa_list=["cattle"], taxa_drop=[])
    found = {r.report_semester: (r.cases, r.disease_status, r.control_measures) for r in out.collect()}
    assert found == {1: (7, "present", "a; b; c"), 2: (None, "absent", "none")}
    plan = _plan(out, True)
    assert " HashAggregate" in plan and plan.index("ObjectHashAggregate") < plan.index(" HashAggregate")


def test_radius_reads_its_points_once(spark):
    pts = spark.range(6).select((F.col("id") % 2).alias("g"), (F.col("id") * 0.1).alias("latitude"), F.lit(1.0).alias("longitude"))
    out = spatial.bounding_radius(pts, ["g"])
    assert "Range" not in _plan(out)
    assert out.count() == 2


def test_totals_of_several_covariances_come_from_one_pass(spark):
    rng, k = np.random.default_rng(3), 2
    def group():
        x, w = rng.normal(size=(9, k)), rng.uniform(0.1, 0.3, 9)
        h, cross = x.T @ (x * w[:, None]), (x * w[:, None]).sum(axis=0)
        sums = [*h.reshape(-1), *rng.normal(size=k), *cross, *rng.normal(size=k), 0.1, w.sum(), 0.2, -3.0, -3.1, -3.2, -3.3]
        return (rng.normal(size=k).tolist(), None, [float(s) for s in sums])
    state = spark.createDataFrame([group() for _ in range(5)], "u array<double>, back array<double>, sums array<double>")
    basis = np.array([[[1.0, 0], [0, 0]], [[0, 0], [0, 1.0]]])
    covs = [np.eye(k), 0.3 * np.eye(k)]
    both = mixed._Totals.of(state, k, basis, covs)
    for cov, there in zip(covs, both):
        alone = mixed._Totals.of(state, k, basis, [cov])[0]
        assert np.isclose(alone.objective, there.objective) and np.allclose(alone.score, there.score) and np.allclose(alone.info, there.info)
    assert not np.isclose(both[0].objective, both[1].objective)
