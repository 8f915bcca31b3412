"""Country links: presence set and import pressure.

Import pressure is a sparse product: (origin, disease, month) presence rows
are joined to link edges on the origin (and year for yearly links), then
summed per destination.  Only linked pairs are ever formed; a destination
with no present, linked origin gets zeros (absent links add nothing), and
self pairs are excluded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATIC_VALUES = ["shared_borders_from_outbreaks", "n_migratory_wildlife_from_outbreaks"]
YEARLY_VALUES = ["ots_trade_dollars_from_outbreaks", "fao_livestock_heads_from_outbreaks"]
ALL_VALUES = STATIC_VALUES + YEARLY_VALUES


def presence_set(monthly: DataFrame) -> DataFrame:
    """(country_origin, disease, month) where an outbreak starts, continues
    or the disease is endemic."""
    return monthly.where(
        F.col("outbreak_start") | F.col("outbreak_subsequent_month") | F.col("endemic")
    ).select(F.col("country_iso3c").alias("country_origin"), "disease", "month")


def present_anywhere(presence: DataFrame) -> DataFrame:
    """(disease, month) present in at least one country."""
    return presence.select("disease", "month").distinct().withColumn(
        "disease_present_anywhere", F.lit(True))


def static_edges(borders: DataFrame, wildlife: DataFrame) -> DataFrame:
    """(origin, destination) -> border indicator and migratory species count."""
    b = borders.select(
        "country_origin", "country_destination",
        (F.upper("shared_border") == "TRUE").cast("double").alias("shared_borders_from_outbreaks"),
    )
    w = wildlife.select(
        "country_origin", "country_destination",
        F.col("n_migratory_wildlife").cast("double").alias("n_migratory_wildlife_from_outbreaks"),
    )
    return b.join(w, on=["country_origin", "country_destination"], how="full")


def yearly_edges(trade: DataFrame, livestock: DataFrame) -> DataFrame:
    t = trade.select(
        "country_origin", "country_destination", "year",
        F.col("ots_trade_dollars").cast("double").alias("ots_trade_dollars_from_outbreaks"),
    )
    lv = livestock.select(
        "country_origin", "country_destination", "year",
        F.col("fao_livestock_heads").cast("double").alias("fao_livestock_heads_from_outbreaks"),
    )
    return t.join(lv, on=["country_origin", "country_destination", "year"], how="full")


def _linked(presence: DataFrame, static: DataFrame, yearly: DataFrame):
    pres = presence.withColumn("year", F.year("month"))
    s = pres.join(static, on="country_origin", how="inner").where(
        F.col("country_origin") != F.col("country_destination"))
    y = pres.join(yearly, on=["country_origin", "year"], how="inner").where(
        F.col("country_origin") != F.col("country_destination"))
    return s, y


def import_pressure(presence: DataFrame, static: DataFrame, yearly: DataFrame) -> DataFrame:
    """K1: (country_iso3c = destination, disease, month) -> summed link values
    over the origins where the disease is present (one aggregation shuffle)."""
    s, y = _linked(presence, static, yearly)
    cols = ["country_destination", "disease", "month"]
    zero = F.lit(None).cast("double")
    parts = s.select(*cols, *STATIC_VALUES, *[zero.alias(c) for c in YEARLY_VALUES]).unionByName(
        y.select(*cols, *[zero.alias(c) for c in STATIC_VALUES], *YEARLY_VALUES)
    )
    return parts.groupBy(F.col("country_destination").alias("country_iso3c"), "disease", "month").agg(
        *[F.sum(c).alias(c) for c in ALL_VALUES]
    )


def merged_edges(static: DataFrame, yearly: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """(origin, destination, year) -> all four link values, self pairs left out.

    Static links hold in every year of the range.  The table's size depends on
    the countries and years only.
    """
    every = static.withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
    both = every.join(yearly, on=["country_origin", "country_destination", "year"], how="full")
    return both.where(F.col("country_origin") != F.col("country_destination"))


def import_origins(presence: DataFrame, edges: DataFrame) -> DataFrame:
    """K1b, nested: (country_iso3c = destination, disease, month) -> ``origins``, an array of
    (country_origin, link values) over the linked origins where the disease is
    present, ordered by origin (a value is null where that link is absent).

    One join and one aggregation; a cell's array is bounded by its origins.
    """
    linked = presence.withColumn("year", F.year("month")).join(edges, on=["country_origin", "year"])
    return linked.groupBy(F.col("country_destination").alias("country_iso3c"), "disease", "month").agg(
        F.sort_array(F.collect_list(F.struct("country_origin", *ALL_VALUES))).alias("origins"))


def with_import_pressure(targets: DataFrame, pressure: DataFrame) -> DataFrame:
    """Left-join summed pressure onto target rows; absent -> 0."""
    out = targets.join(pressure, on=["country_iso3c", "disease", "month"], how="left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ALL_VALUES})


def with_origins(targets: DataFrame, origins: DataFrame) -> DataFrame:
    """Target rows with their array of origins; null where there is none."""
    return targets.join(origins, on=["country_iso3c", "disease", "month"], how="left")


def flat_origins(nested: DataFrame) -> DataFrame:
    """One row per linked origin; a single null-origin row where none."""
    rest = [c for c in nested.columns if c != "origins"]
    flat = nested.select(*rest, F.explode_outer("origins").alias("_o"))
    return flat.select(*rest, "_o.country_origin", *[f"_o.{v}" for v in ALL_VALUES])
