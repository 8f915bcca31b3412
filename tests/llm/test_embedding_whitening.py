from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import embedding_whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long, deviation double, component int, id string, z int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 1, 1.0, 1, "i", 1) for i, v in rows], SCHEMA)


def brute(rows, wanted=4):
    """The contract in fractions and a dense eigen-decomposition."""
    usable = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    apart = [[Fraction(x[k] * n - sums[k], n) for k in range(d)] for x in fit]
    v = np.array([[float(sum(a[i] * a[j] for a in apart) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:wanted], u[:, ::-1][:, :wanted]
    return [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), (np.array(x) - np.array(sums) / n) @ u / np.sqrt(e)) for i, x in usable], n, e / np.trace(v)


def same_rows(got, want, n, shares, digits=1e-8):
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert sum(map(len, by_id.values())) == len(want) * len(shares)
    signs = None
    for i, deviation, z in want:
        here = sorted(by_id[i], key=lambda r: r["component"])
        white = np.array([r["whitened"] for r in here])
        if signs is None and np.all(np.abs(z) > 1e-6):
            signs = np.sign(white * z)
        if signs is not None:
            assert np.allclose(white, z * signs, rtol=0, atol=digits)
        assert all(int(r["deviation"]) == deviation and r["n"] == n for r in here)
        assert np.allclose([r["explained"] for r in here], shares, rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in here)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((160, 12)) * np.linspace(2, 0.2, 12) + 0.3
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(1000 + k, base[3]) for k in range(200)]  # many copies of one vector
    rows += [(2000, None), (2001, [None] + [0.0] * 11), (2002, [np.nan] * 12), (2003, [np.inf] * 12)]
    got = W.whiten(table(spark, rows).repartition(5)).collect()
    want, n, shares = brute(rows)
    assert n == 160
    same_rows(got, want, n, shares)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (v * 2**20).astype(np.float32)) for i, v in enumerate(rng.standard_normal((40, 3)) + 100)]
    want, n, shares = brute(rows)
    same_rows(W.whiten(table(spark, rows)).collect(), want, n, shares)


def test_degenerate_tables(spark):
    assert W.whiten(table(spark, [])).count() == 0
    assert W.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    one = W.whiten(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["n"], int(r["deviation"])) for r in one] == [(1, None, None, 1, 0), (2, None, None, 1, 0)] * 2
    line = W.whiten(table(spark, [(k, [k, 2.0 * k, 0.0]) for k in range(5)])).collect()
    assert {r["component"] for r in line if r["whitened"] is None} == {2, 3}
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-12 for r in line)
    with pytest.raises(ValueError):
        W.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(1, 6), st.integers(0, 10**6), st.sampled_from(["spread", "low rank", "cluster", "tied"]))
def test_components_and_inertia(d, wanted, seed, kind):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = np.sort(rng.random(d))[::-1] + 0.01
    if kind == "low rank":
        e[rng.integers(0, d) + 1 :] = 0
    if kind == "cluster":
        e = 1 + 1e-7 * e
    if kind == "tied":
        e[: 1 + d // 2] = 2.0
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    form = W.tridiagonal(v) if d > 1 else (v[0, :1], np.zeros(0))
    for s in (-0.1, 0.005, 0.5, 1.5, 3.0):
        if np.abs(e - s).min() > 1e-6:
            assert W.count_above(form, s) == (e > s).sum()
    values, vectors = W.top_components(v, wanted)
    k = min(wanted, int((e > 1e-12).sum()))
    assert len(values) == k and np.allclose(values, e[:k], rtol=1e-10)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * values) < 1e-11
