"""The mixed-effects fit against the Laplace deviance that it minimises."""

import numpy as np
import pytest

from panelcast.operators import mixed


def laplace(groups, cov, start=None):
    """Laplace log-likelihood at the joint mode of intercept and slopes, by dense Newton steps."""
    k, precision = len(cov), np.linalg.inv(cov)
    b, us = start or (0.0, [np.zeros(k) for _ in groups])
    for _ in range(200):
        g0 = h0 = 0.0
        parts = []
        for (x, y, w0), u in zip(groups, us):
            p = 1 / (1 + np.exp(-(b + x @ u)))
            r, w = w0 * (y - p), w0 * p * (1 - p)
            v = np.linalg.inv(x.T @ (x * w[:, None]) + precision)
            s, t = v @ (x.T @ r - precision @ u), v @ (x.T @ w)
            g0 += r.sum() - (x.T @ w) @ s
            h0 += w.sum() - (x.T @ w) @ t
            parts.append((s, t))
        db = g0 / h0
        b += db
        us = [u + s - t * db for u, (s, t) in zip(us, parts)]
        if abs(db) + max(np.abs(s).max() for s, _ in parts) < 1e-11:
            break
    ll = 0.0
    for (x, y, w0), u in zip(groups, us):
        eta = b + x @ u
        p = 1 / (1 + np.exp(-eta))
        a = x.T @ (x * (w0 * p * (1 - p))[:, None]) + precision
        ll += -(w0 * np.logaddexp(0, np.where(y > 0, -eta, eta))).sum() - 0.5 * (
            u @ precision @ u + np.linalg.slogdet(cov)[1] + np.linalg.slogdet(a)[1])
    return ll, b, us


def data(rng, n_groups, sizes, cov, intercept):
    groups = []
    for _ in range(n_groups):
        u, n = rng.multivariate_normal(np.zeros(len(cov)), cov), int(rng.integers(*sizes))
        x = rng.normal(size=(n, len(cov)))
        y = (rng.random(n) < 1 / (1 + np.exp(-(intercept + x @ u)))).astype(float)
        groups.append((x, y, rng.integers(1, 4, n).astype(float)))
    return groups


@pytest.mark.parametrize("block", [[], ["x0", "x1"]])
def test_variances_maximise_the_laplace_likelihood(spark, block, monkeypatch):
    monkeypatch.setattr(mixed, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    cov = np.array([[0.8, 0.4, 0], [0.4, 0.6, 0], [0, 0, 0.3]])
    groups = data(rng, 25, (20, 90), cov, -1.0)
    rows = [(f"g{i}", bool(a), *map(float, b), int(c)) for i, (x, y, w) in enumerate(groups) for b, a, c in zip(x, y, w)]
    df = spark.createDataFrame(rows, "disease string, outbreak_start boolean, x0 double, x1 double, x2 double, count int").repartition(6)
    fit = mixed.fit_mixed_logit(df, ["x0", "x1", "x2"], block=block, variance_tol=1e-7)
    assert fit.converged and fit.iterations <= 20
    best, b, us = laplace(groups, fit.covariance)
    assert abs(best - fit.loglik_laplace) < 1e-3 and abs(b - fit.intercept) < 1e-3
    slopes = {r["disease"]: r["u"] for r in fit.slope_frame.collect()}
    assert np.abs(np.array([slopes[f"g{i}"] for i in range(25)]) - us).max() < 5e-3
    # no neighbouring covariance is better
    for a, c in [(0, 0), (1, 1), (2, 2)] + ([(0, 1)] if block else []):
        for step in (-0.03, 0.03):
            near = fit.covariance.copy()
            near[a, c] = near[c, a] = near[a, c] + step
            assert laplace(groups, near)[0] < best


def test_a_variance_without_evidence_goes_to_its_floor(spark):
    rng = np.random.default_rng(8)
    groups = data(rng, 30, (40, 60), np.diag([1.0, 1e-12]), 0.2)
    rows = [(f"g{i}", bool(a), *map(float, b), 1) for i, (x, y, _) in enumerate(groups) for b, a in zip(x, y)]
    df = spark.createDataFrame(rows, "disease string, outbreak_start boolean, x0 double, x1 double, count int")
    fit = mixed.fit_mixed_logit(df, ["x0", "x1"])
    assert fit.converged and fit.variances[1] < 0.02 < fit.variances[0]


def test_rows_with_nulls_are_left_out_and_an_empty_design_raises(spark):
    schema = "disease string, outbreak_start boolean, x0 double, count int"
    rows = [("a", i % 3 == 0, float(i % 5), 1) for i in range(60)] + [("b", i % 2 == 0, float(i % 7), 1) for i in range(60)]
    extra = [(None, True, 1.0, 1), ("a", None, 1.0, 1), ("a", True, None, 1), ("b", True, 1.0, None)]
    full = mixed.fit_mixed_logit(spark.createDataFrame(rows, schema), ["x0"])
    same = mixed.fit_mixed_logit(spark.createDataFrame(rows + extra, schema), ["x0"])
    assert full.n_obs == same.n_obs == 120 and abs(full.intercept - same.intercept) < 1e-9
    with pytest.raises(ValueError):
        mixed.fit_mixed_logit(spark.createDataFrame(extra, schema), ["x0"])
