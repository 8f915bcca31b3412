"""Outbreak impact summary per thread x taxa."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMPACT_KEY = ["outbreak_thread_id", "country", "country_iso3c", "disease", "taxa"]


def impact_events(events: DataFrame) -> DataFrame:
    """Events with a usable country (aquatic events are kept here)."""
    return events.where(F.col("country_iso3c").isNotNull() & (F.col("country_iso3c") != "NA"))


def impact_outbreaks(events: DataFrame, outbreaks: DataFrame) -> DataFrame:
    """Outbreak rows joined to their report's event (inner join on report_id)."""
    ev = impact_events(events).select(
        "report_id", "outbreak_thread_id", "country", "country_iso3c", "disease")
    ob = outbreaks.withColumnRenamed("species_name", "taxa")
    return ob.join(ev, on="report_id", how="inner")


def impact_summary(events: DataFrame, outbreaks: DataFrame) -> DataFrame:
    """Totals (missing counts ignored, nothing -> 0) and first / last outbreak
    date per (thread, country, disease, taxa)."""
    j = impact_outbreaks(events, outbreaks)
    tot = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return j.groupBy(*IMPACT_KEY).agg(
        tot("cases").alias("total_cases"),
        tot("deaths").alias("total_deaths"),
        tot("killed_and_disposed").alias("total_killed_and_disposed"),
        tot("slaughtered_for_commercial_use").alias("total_slaughtered_for_commercial_use"),
        F.min("outbreak_start_date").alias("outbreak_start_date"),
        F.max("outbreak_start_date").alias("outbreak_end_date"),
    )
