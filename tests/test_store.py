"""The prediction store and the reads over it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import attribution as A
from panelcast.operators import links
from panelcast.plans import queries_readside as Q
from panelcast.plans import reads
from panelcast.sources.store import PARTITIONS, PredictionStore

from conftest import SF_SMALL

SCHEMA = "country string, disease string, month date, p double"


def rows(diseases, months, p):
    return [(c, d, m, p) for c in ("A", "B") for d in diseases for m in months]


JAN, FEB = dt.date(2001, 1, 1), dt.date(2001, 2, 1)


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    store = PredictionStore(spark, str(tmp_path))
    store.write("t", spark.createDataFrame(rows(["007", "x/y"], [JAN, FEB], 0.1), SCHEMA), PARTITIONS)
    store.write("t", spark.createDataFrame(rows(["007"], [FEB], 0.9), SCHEMA), PARTITIONS)
    other = PredictionStore(spark.newSession(), str(tmp_path))
    assert other.names() == ["t"]
    back = other.read("t")
    assert [(f.name, f.dataType.simpleString()) for f in back.schema] == [tuple(c.split()) for c in SCHEMA.split(", ")]
    got = {(r["disease"], r["month"]): r["p"] for r in back.collect()}
    assert got == {("007", JAN): 0.1, ("007", FEB): 0.9, ("x/y", JAN): 0.1, ("x/y", FEB): 0.1} and back.count() == 8


def test_tables_without_partitions_are_replaced_whole(spark, tmp_path):
    store = PredictionStore(spark, str(tmp_path))
    for p in (0.1, 0.2):
        store.write("t", spark.createDataFrame(rows(["d"], [JAN], p), SCHEMA))
    assert {r["p"] for r in store.read("t").collect()} == {0.2} and store.read("t", country=["A"]).count() == 1


@pytest.mark.parametrize("question", ["variable_importance", "variable_importance_by_origin", "origin_import_risk", "top_origins"])
def test_reads_open_the_wanted_partitions_only(spark, question):
    r = Q._reads(spark, SF_SMALL)
    df = getattr(r, question)(["NATION_3"], ["brand_number_1"], [dt.date(1998, 3, 1)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "month" in line.split("PartitionFilters")[1]]
    assert scans and all("brand_number_1" in s.split("PartitionFilters")[1] for s in scans)
    assert {(x["disease"], x["month"]) for x in df.select("disease", "month").collect()} <= {("brand_number_1", dt.date(1998, 3, 1))}
    everything = getattr(r, question)(None, None, [dt.date(1998, 3, 1)])
    assert everything.count() >= df.count()


def test_attribution_by_hand(spark):
    """Strict sums, zero sums, cells without origins, shares and ranks."""
    o = "array<struct<country_origin: string, shared_borders_from_outbreaks: double, n_migratory_wildlife_from_outbreaks: double, " \
        "ots_trade_dollars_from_outbreaks: double, fao_livestock_heads_from_outbreaks: double>>"
    cells = [
        ("X", "d", JAN, [("P", 1.0, None, 30.0, 0.0), ("Q", 3.0, 2.0, 10.0, 0.0)]),
        ("X", "d", FEB, None),
    ]
    df = spark.createDataFrame([(c, d, m, False, False, False, 0.5, x) for c, d, m, x in cells],
                               f"country_iso3c string, disease string, month date, outbreak_start boolean, endemic boolean, "
                               f"outbreak_ongoing boolean, predicted_outbreak_probability double, origins {o}")
    coefs = spark.createDataFrame([("d", v, 0.5) for v in reads.LINKS], "disease string, variable string, coef double")
    scaling = spark.createDataFrame([(v, 2.0, 4.0) for v in reads.LINKS], "key string, mean double, sd double")
    names = spark.createDataFrame([("X", "Xland"), ("P", "Pland"), ("Q", "Qland")], "country_iso3c string, country string")
    found = A.with_link_importance(df, coefs, scaling, reads.LINKS)
    long = {(r["month"], r["variable"], r["country_origin_iso3c"]): (r["x"], r["sum_x"], r["disagg_variable_importance"])
            for r in A.variable_importance_by_origin(found, names, reads.LINKS).collect()}
    assert len(long) == 8 + 4
    assert long[JAN, "shared_borders_from_outbreaks", "P"] == (1.0, 4.0, (4 - 2) / 4 * 0.5 / 4 * 1)
    assert long[JAN, "n_migratory_wildlife_from_outbreaks", "Q"] == (2.0, None, None)  # another origin's value is unknown
    assert long[JAN, "fao_livestock_heads_from_outbreaks", "P"] == (0.0, 0.0, None)
    assert long[FEB, "ots_trade_dollars_from_outbreaks", None] == (None, None, None)
    cells = A.with_contributions(found, reads.LINKS)
    risk = {r["country_origin"]: r["contribution_to_import_risk"] for r in A.origin_import_risk(cells, names).collect()}
    borders, trade = (4 - 2) / 4 * 0.5, (40 - 2) / 4 * 0.5
    assert risk == pytest.approx({"Pland": borders / 4 + trade * 0.75, "Qland": borders * 0.75 + trade / 4})
    assert [(r["country_origin_iso3c"], r["rank"]) for r in A.top_origins(cells, names, 1).collect()] == [("P", 1)]
    share = risk["Pland"] / sum(risk.values())
    lumped = {r["origin_group"]: (r["share"], r["n_origins"]) for r in A.origin_share_lumped(cells, 0.4).collect()}
    assert lumped["P"] == (pytest.approx(share), 1) and lumped["other"] == (pytest.approx(1 - share), 1)


def test_nested_origins_match_the_pairs(spark):
    presence = spark.createDataFrame([("P", "d", JAN), ("Q", "d", JAN), ("X", "d", JAN), ("P", "d", dt.date(2002, 1, 1))],
                                     "country_origin string, disease string, month date")
    static = spark.createDataFrame([("P", "X", 1.0, 2.0), ("X", "X", 9.0, 9.0)],
                                   "country_origin string, country_destination string, shared_borders_from_outbreaks double, n_migratory_wildlife_from_outbreaks double")
    yearly = spark.createDataFrame([("P", "X", 2001, 5.0, 6.0), ("Q", "X", 2001, 7.0, 8.0)],
                                   "country_origin string, country_destination string, year int, ots_trade_dollars_from_outbreaks double, fao_livestock_heads_from_outbreaks double")
    nested = links.import_origins(presence, links.merged_edges(static, yearly, 2001, 2002))
    targets = spark.createDataFrame([("X", "d", JAN), ("X", "d", dt.date(2002, 1, 1)), ("P", "d", JAN)], "country_iso3c string, disease string, month date")
    flat = links.flat_origins(links.with_origins(targets, nested))
    got = {(r["country_iso3c"], r["month"].year, r["country_origin"]): tuple(r)[4:] for r in flat.collect()}
    assert got == {("X", 2001, "P"): (1.0, 2.0, 5.0, 6.0), ("X", 2001, "Q"): (None, None, 7.0, 8.0),
                   ("X", 2002, "P"): (1.0, 2.0, None, None), ("P", 2001, None): (None,) * 4}
    pressure = links.import_pressure(presence, static, yearly).where("country_iso3c = 'X'").agg(F.sum("ots_trade_dollars_from_outbreaks")).first()[0]
    assert pressure == 12.0


def test_publishing_some_months_leaves_the_others(spark, tmp_path):
    store = PredictionStore(spark, str(tmp_path))
    features = spark.createDataFrame([("A", "d", JAN, 1.0), ("A", "d", FEB, 2.0)], "country_iso3c string, disease string, month date, x double")
    coefs, scaling = spark.createDataFrame([("d", "x", 1.0)], "disease string, variable string, coef double"), spark.createDataFrame([("x", 0.0, 1.0)], "key string, mean double, sd double")

    def predictions(p):
        return features.select("country_iso3c", "disease", "month").withColumn("predicted_outbreak_probability", F.lit(p))

    reads.publish(store, "m", features, features, coefs, scaling, predictions(0.25))
    reads.publish(store, "m", features, features, coefs, scaling, predictions(0.75), months=[FEB])
    got = {r["month"]: r["predicted_outbreak_probability"] for r in store.read("network_m_augment_predict").collect()}
    assert got == {JAN: 0.25, FEB: 0.75}
    assert store.names() == sorted(f"network_m_{t}" for t in reads.TABLES)
