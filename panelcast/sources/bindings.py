"""Bindings: shape the driver's star-schema tables into the domain schemas.

Each function returns a lazy DataFrame in one of the domain shapes
(six-month reports, outbreak events, link tables, yearly covariates, ...),
so every operator is exercised on data whose size grows with the inputs.
Dimension joins are left to Catalyst/AQE (no forced broadcast of tables
that grow with the scale factor).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CONTROL_MEASURES
from .tables import read_table

# Binding parameters (shared with the oracle SQL).
AS_OF = dt.date(2001, 12, 1)
GRID_START = dt.date(1995, 1, 1)
FIRST_YEAR = 1995

B1_STATUS = {"R": "present", "A": "absent", "N": "unreported"}
B1_CONTROL = {
    1: "; ".join(CONTROL_MEASURES[0:2] + [CONTROL_MEASURES[5]]),
    2: "; ".join(CONTROL_MEASURES[2:4] + [CONTROL_MEASURES[7]]),
    3: "; ".join([CONTROL_MEASURES[4], CONTROL_MEASURES[6], CONTROL_MEASURES[8]]),
    4: "na",
    6: "; ".join(CONTROL_MEASURES[9:13]),
    7: "; ".join(CONTROL_MEASURES[13:17] + [CONTROL_MEASURES[5]]),
}
B1_TAXA_SUFFIX_LINE = 3  # lines carrying a " (mixed herd)" suffix on the taxa
B1_TAXA_MERGE = {"economy": "economy/promo", "promo": "economy/promo"}
B1_TAXA_LIST = ["standard", "economy/promo", "medium", "large"]
B1_TAXA_DROP: list[str] = []

B2_LOCAL = 53  # orders whose key is a multiple report their country's own disease

PREDICTOR_VARS = [
    "continent",
    "log_gdp_dollars",
    "log_human_population",
    "log_target_taxa_population",
    "log_veterinarians",
    "disease_present_anywhere",
    "shared_borders_from_outbreaks",
    "ots_trade_dollars_from_outbreaks",
    "fao_livestock_heads_from_outbreaks",
    "n_migratory_wildlife_from_outbreaks",
]


def _case_map(c, mapping: dict):
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def six_month_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one report line per lineitem, keyed like the six-month summary."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    su = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    na = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    pa = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    df = (
        li.join(su, li.l_suppkey == su.s_suppkey)
        .join(na, F.col("s_nationkey") == na.n_nationkey)
        .join(pa, li.l_partkey == pa.p_partkey)
    )
    ln = F.col("l_linenumber")
    taxa = F.lower("p_type")
    return df.select(
        F.col("n_name").alias("country_iso3c"),
        F.year("l_shipdate").alias("report_year"),
        F.when(F.month("l_shipdate") < 7, 1).otherwise(2).alias("report_semester"),
        F.col("p_brand").alias("disease"),
        F.col("l_linestatus").alias("disease_population"),
        F.when(ln == B1_TAXA_SUFFIX_LINE, F.concat(taxa, F.lit(" (mixed herd)")))
        .otherwise(taxa)
        .alias("taxa"),
        ln.cast("string").alias("serotype"),
        _case_map(ln, B1_CONTROL).alias("control_measures"),
        _case_map(F.col("l_returnflag"), B1_STATUS).alias("disease_status"),
        F.when(ln == 7, F.lit(None).cast("string"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("cases"),
    )


def outbreak_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: outbreak event reports, one per lineitem, thread = order."""
    o = read_table(
        spark, sf_dir, "orders",
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
    )
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    df = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .join(li, o.o_orderkey == li.l_orderkey)
    )
    od = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    return df.select(
        F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string")).alias("report_id"),
        k.alias("outbreak_thread_id"),
        F.when(F.col("l_linenumber") == 1, "immediate notification")
        .otherwise("follow-up")
        .alias("report_type"),
        F.col("n_name").alias("country"),
        F.col("n_name").alias("country_iso3c"),
        # the nowcast family's recoded names, and one disease of each country alone
        F.when(k % B2_LOCAL == 0, F.concat(F.lit("local_"), F.lower("n_name")))
        .otherwise(F.concat(F.lit("brand_number_"), ((F.col("o_custkey") * 5 + k) % 25 + 1).cast("string")))
        .alias("disease"),
        (k % 13 == 0).alias("is_aquatic"),
        F.date_add(od, F.col("l_linenumber") * 10).alias("report_date"),
        F.when(k % 11 == 0, F.lit(None).cast("date")).otherwise(od).alias("date_of_start_of_the_event"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date"))
        .otherwise(F.add_months(od, (k % 5).cast("int")))
        .alias("date_event_resolved"),
    )


def _trade_base(spark, sf_dir):
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    )
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n1 = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name").withColumnsRenamed(
        {"n_nationkey": "o_nk", "n_name": "country_origin"})
    n2 = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name").withColumnsRenamed(
        {"n_nationkey": "d_nk", "n_name": "country_destination"})
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n1), F.col("s_nationkey") == F.col("o_nk"))
        .join(F.broadcast(n2), F.col("c_nationkey") == F.col("d_nk"))
    )


def yearly_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, destination, year) -> trade dollars and livestock heads."""
    return (
        _trade_base(spark, sf_dir)
        .groupBy("country_origin", "country_destination", F.year("o_orderdate").alias("year"))
        .agg(
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias(
                "ots_trade_dollars"),
            F.sum("l_quantity").alias("fao_livestock_heads"),
        )
    )


def value_trade(spark, sf_dir):
    return yearly_links(spark, sf_dir).select(
        "country_origin", "country_destination", "year", "ots_trade_dollars")


def livestock_trade(spark, sf_dir):
    return yearly_links(spark, sf_dir).select(
        "country_origin", "country_destination", "year", "fao_livestock_heads")


def static_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered nation pairs inside one region (the nation table is 25 rows)."""
    a = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").alias("a")
    b = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").alias("b")
    pairs = a.join(
        b,
        (F.col("a.n_regionkey") == F.col("b.n_regionkey"))
        & (F.col("a.n_nationkey") != F.col("b.n_nationkey")),
    )
    return pairs.select(
        F.col("a.n_name").alias("country_origin"),
        F.col("b.n_name").alias("country_destination"),
        F.when(F.abs(F.col("a.n_nationkey") - F.col("b.n_nationkey")) <= 10, "TRUE")
        .otherwise("FALSE")
        .alias("shared_border"),
        ((F.col("a.n_nationkey") * 7 + F.col("b.n_nationkey") * 3) % 5).cast("int").alias(
            "n_migratory_wildlife"),
    )


def shared_borders(spark, sf_dir):
    return static_links(spark, sf_dir).select("country_origin", "country_destination", "shared_border")


def wildlife_migration(spark, sf_dir):
    return static_links(spark, sf_dir).select(
        "country_origin", "country_destination", "n_migratory_wildlife")


def _orders_by_customer_nation(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(
        F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly GDP by country, with gaps (nation key % 9 = 0, even years)."""
    df = _orders_by_customer_nation(spark, sf_dir)
    yr = F.year("o_orderdate")
    return (
        df.where(~((F.col("n_nationkey") % 9 == 0) & (yr % 2 == 0)))
        .groupBy(F.col("n_name").alias("country_iso3c"), yr.alias("year"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("gdp_dollars"))
    )


def human_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders_by_customer_nation(spark, sf_dir)
    return df.groupBy(
        F.col("n_name").alias("country_iso3c"), F.year("o_orderdate").alias("year")
    ).agg((F.countDistinct("o_custkey") * 1000).cast("double").alias("human_population"))


def vets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    df = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
    )
    return df.groupBy(
        F.col("n_name").alias("country_iso3c"), F.year("o_orderdate").alias("year")
    ).agg(F.countDistinct("l_suppkey").cast("double").alias("veterinarian_count"))


def taxa_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    df = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
        .join(p, li.l_partkey == p.p_partkey)
    )
    taxa = F.lower("p_type")
    merged = _case_map(taxa, B1_TAXA_MERGE).otherwise(taxa) if B1_TAXA_MERGE else taxa
    return df.groupBy(
        F.col("n_name").alias("country_iso3c"), F.year("o_orderdate").alias("year"),
        merged.alias("taxa"),
    ).agg(F.sum("l_quantity").alias("population"))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country dimension with an authored continent (null for key 24)."""
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("country"),
        F.col("n_name").alias("country_iso3c"),
        F.when(F.col("n_nationkey") == 24, F.lit(None).cast("string"))
        .otherwise(F.col("r_name"))
        .alias("continent"),
    )


def outbreak_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One located outbreak per lineitem, linked to its B2 report."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_shipdate",
    )
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    df = li.join(p, li.l_partkey == p.p_partkey)
    q = F.col("l_quantity").cast("int")
    ln = F.col("l_linenumber")
    return df.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string")).alias("report_id"),
        F.lower("p_type").alias("species_name"),
        q.alias("cases"),
        F.when(ln == 2, F.lit(None).cast("int")).otherwise(q % 4).alias("deaths"),
        (q % 3).alias("killed_and_disposed"),
        F.when(ln % 2 == 0, F.lit(None).cast("int")).otherwise(F.lit(1)).alias(
            "slaughtered_for_commercial_use"),
        F.to_date("l_shipdate").alias("outbreak_start_date"),
        # a thread's outbreaks lie within about 60 km of each other
        ((F.col("l_orderkey") * 37) % 120 - 60 + (ln * 7) % 5 * 0.1).cast("double").alias("latitude"),
        ((F.col("l_orderkey") * 53) % 340 - 170 + (ln * 3) % 7 * 0.1).cast("double").alias("longitude"),
    )


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted per (user, event type, day)."""
    ev = read_table(spark, sf_dir, "events", "user_id", "event_type", "ts")
    return ev.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("cases"))
