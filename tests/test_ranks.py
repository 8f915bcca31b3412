"""Exact ranks, quantiles, samples and folds against sorting on the driver."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import ranks
from panelcast.operators.splits import stratified_folds


def md5(seed, *key):
    return hashlib.md5("|".join([str(seed), *map(str, [k for k in key if k is not None])]).encode()).hexdigest()


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"k{i % 50}", [None, "a", "b"][i % 7 % 3], float(i * i % 97) if i % 11 else None) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, name string, grp string, x double").repartition(7)


def test_hash_rank_is_the_place_in_hash_order(table):
    rows = table.collect()
    got = {r["id"]: r["rank"] for r in ranks.hash_rank(table, ["id", "name"], ["grp"], 3, range_rows=100).collect()}
    for g in (None, "a", "b"):
        order = sorted((r for r in rows if r["grp"] == g), key=lambda r: md5(3, r["id"], r["name"]))
        assert [got[r["id"]] for r in order] == list(range(1, len(order) + 1))


def test_hash_rank_plan_has_no_window_over_everything(table):
    plan = ranks.hash_rank(table, ["id"], [], 3, range_rows=100)._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    assert windows and all("_range" in line for line in windows)


@pytest.mark.parametrize("n", [0, 1, 17, 2999, 3000, 5000])
def test_hash_sample_takes_exactly_the_smallest_hashes(table, n):
    want = sorted((r["id"] for r in table.collect()), key=lambda i: md5(4, i))[:n]
    for layout in (table, table.coalesce(1)):
        got = [r["id"] for r in ranks.hash_sample(layout, ["id"], n, 4, range_rows=100).collect()]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("q", [0.0, 0.15, 0.5, 0.999, 1.0])
def test_exact_quantile_interpolates(table, q):
    x = [r["x"] for r in table.collect() if r["x"] is not None]
    assert abs(ranks.exact_quantile(table, "x", q).first()["quantile"] - np.quantile(x, q)) < 1e-9
    for r in ranks.exact_quantile(table, "x", q, ["grp"]).collect():
        mine = [s["x"] for s in table.collect() if s["x"] is not None and s["grp"] == r["grp"]]
        assert abs(r["quantile"] - np.quantile(mine, q)) < 1e-9


def test_quantile_of_nothing(table, spark):
    assert ranks.exact_quantile(table.where("x < 0"), "x", 0.5).count() == 0
    with pytest.raises(ValueError):
        ranks.exact_quantile(table, "x", 1.5)
    hot = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("x"))
    assert ranks.exact_quantile(hot, "x", 0.4).first()["quantile"] == 7


def test_fold_sizes_of_each_stratum_differ_by_one(table):
    folds = stratified_folds(table, ["id"], 10, ["grp"])
    sizes = {}
    for r in folds.groupBy("grp", "fold").count().collect():
        sizes.setdefault(r["grp"], []).append(r["count"])
    assert set(sizes) == {None, "a", "b"}
    assert all(len(s) == 10 and max(s) - min(s) <= 1 for s in sizes.values())
    again = {r["id"]: r["fold"] for r in stratified_folds(table.coalesce(2), ["id"], 10, ["grp"]).collect()}
    assert again == {r["id"]: r["fold"] for r in folds.collect()}
