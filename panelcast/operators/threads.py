"""Outbreak threads -> country x disease x month panel.

A thread is an interval [start month, end month].  Instead of joining every
report to every month of the grid, each (thread, country, disease) is
expanded over its own active months only (``explode(sequence)``), flags are
OR-ed per cell, and the result is left-joined onto the grid.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import period_idx, semester_months
from . import panel

def _month():
    return F.expr("interval 1 month")


def clean_events(events: DataFrame) -> DataFrame:
    """Drop events without a usable country and aquatic events (null counts as aquatic)."""
    return events.where(
        F.col("country_iso3c").isNotNull() & (F.col("country_iso3c") != "NA")
    ).where(~F.col("is_aquatic"))


def thread_bounds(events: DataFrame, as_of: dt.date) -> DataFrame:
    """Per (thread, country, disease): the whole thread's start / end month.

    start = earliest report month or stated start (nulls ignored);
    end = latest resolved month, else report month; a thread never resolved
    whose end is within the last ~12 months stays open (end far ahead).
    Events without a thread id are their own thread.
    """
    as_of_m = F.trunc(F.lit(as_of), "month")
    prev_year = F.trunc(F.date_sub(as_of_m, 365), "month")
    far = F.trunc(F.date_add(as_of_m, 36500), "month")
    ev = clean_events(events).select(
        F.coalesce(
            F.col("outbreak_thread_id").cast("string"), F.concat(F.lit("report:"), F.col("report_id"))
        ).alias("_thread"),
        "outbreak_thread_id",
        "country_iso3c",
        "disease",
        F.trunc("report_date", "month").alias("report_month"),
        F.trunc("date_of_start_of_the_event", "month").alias("start_m"),
        F.trunc("date_event_resolved", "month").alias("resolved_m"),
    )
    cell = ev.groupBy("_thread", "outbreak_thread_id", "country_iso3c", "disease").agg(
        F.min(F.least("report_month", "start_m")).alias("_s"),
        F.max(F.coalesce("resolved_m", "report_month")).alias("_e"),
        F.bool_and(F.col("resolved_m").isNull()).alias("_open"),
    )
    w = Window.partitionBy("outbreak_thread_id", "_thread")  # the id too: rows dealt by it need no other shuffle
    b = cell.select(
        "outbreak_thread_id",
        "country_iso3c",
        "disease",
        F.min("_s").over(w).alias("outbreak_start_month"),
        F.max("_e").over(w).alias("_end"),
        F.bool_and("_open").over(w).alias("_never_resolved"),
    )
    return b.select(
        "outbreak_thread_id",
        "country_iso3c",
        "disease",
        "outbreak_start_month",
        F.when((F.col("_end") >= prev_year) & F.col("_never_resolved"), far)
        .otherwise(F.col("_end"))
        .alias("outbreak_end_month"),
    )


def thread_spans(events: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct (country, disease, start, end) of the threads.

    All that the panel needs of the events, in one scan of them; its size is
    bounded by the months of the (country, disease) pairs, not by the threads.
    """
    return thread_bounds(events, as_of).drop("outbreak_thread_id").distinct()


def thread_cell_flags(bounds: DataFrame, grid_start: dt.date, as_of: dt.date) -> DataFrame:
    """(country, disease, month) -> outbreak_start / outbreak_subsequent_month,
    from each thread's active months clipped to [grid_start, as_of]."""
    # a thread whose end precedes its start still has its start month
    lo = F.greatest(F.col("outbreak_start_month"), F.lit(grid_start))
    hi = F.least(F.greatest(F.col("outbreak_end_month"), F.col("outbreak_start_month")),
                 F.trunc(F.lit(as_of), "month"))
    act = bounds.where(lo <= hi).select(
        "country_iso3c",
        "disease",
        "outbreak_start_month",
        "outbreak_end_month",
        F.explode(F.sequence(lo, hi, _month())).alias("month"),
    )
    m, s, e = F.col("month"), F.col("outbreak_start_month"), F.col("outbreak_end_month")
    return act.groupBy("country_iso3c", "disease", "month").agg(
        F.bool_or(m == s).alias("outbreak_start"),
        F.bool_or((m > s) & (m <= e)).alias("outbreak_subsequent_month"),
    )


def endemic_months(
    predictions: DataFrame,
    as_of: dt.date,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """(country, disease, month) where reported-or-predicted cases > 0.

    The latest semester's conditions are carried forward to the semester of
    ``as_of`` for the (country, disease) pairs seen in it; semesters are
    spread to their six months.  ``pairs`` optionally restricts the input.
    """
    p = predictions
    if pairs is not None:
        p = p.join(pairs.select("country_iso3c", "disease").distinct(),
                   on=["country_iso3c", "disease"], how="left_semi")
    pos = p.where(F.coalesce(F.col("cases"), F.col("cases_predicted")) > 0).select(
        "country_iso3c", "disease", period_idx().alias("period")
    )
    latest = pos.agg(F.max("period")).scalar()
    current = as_of.year * 2 + (0 if as_of.month < 7 else 1)
    carried = (
        pos.where(F.col("period") == latest)
        .select("country_iso3c", "disease", "period")
        .distinct()
        .where(F.col("period") < F.lit(current))
        .select(
            "country_iso3c", "disease",
            F.explode(F.sequence(F.col("period") + 1, F.lit(current))).alias("period"),
        )
    )
    allp = pos.unionByName(carried)
    return (
        allp.select(
            "country_iso3c",
            "disease",
            F.explode(
                semester_months(F.floor(F.col("period") / 2).cast("int"),
                                (F.pmod(F.col("period"), F.lit(2)) + 1).cast("int"))
            ).alias("month"),
        )
        .distinct()
        .withColumn("endemic", F.lit(True))
    )


def single_country_diseases(events: DataFrame) -> DataFrame:
    """Diseases reported from exactly one country."""
    return _in_one_country(clean_events(events))


def _in_one_country(pairs: DataFrame) -> DataFrame:
    return (
        pairs.groupBy("disease")
        .agg(F.countDistinct("country_iso3c").alias("n_countries"))
        .where(F.col("n_countries") == 1)
        .select("disease")
    )


def thread_month_panel(
    events: DataFrame | None,
    grid_start: dt.date,
    as_of: dt.date,
    endemic: DataFrame | None = None,
    remove_single_country: bool = False,
    primary_diseases: DataFrame | None = None,
    spans: DataFrame | None = None,
) -> DataFrame:
    """P4 + P6 + P7: the monthly outbreak panel of every country x disease.

    Flags: outbreak_start (suppressed when the month is already ongoing or
    endemic; the suppression is kept in outbreak_start_while_ongoing_or_endemic),
    outbreak_subsequent_month, outbreak_ongoing, endemic,
    disease_country_combo_unreported, disease_in_single_country
    (+ disease_primary_taxa when ``primary_diseases`` is given).  ``spans`` are
    the written ``thread_spans`` of the events, which are not read then.
    """
    ev = thread_spans(events, as_of) if spans is None else spans  # a row for every clean event's pair at least
    cells = thread_cell_flags(ev, grid_start, as_of)
    diseases = ev.select("disease").distinct()
    grid = (
        diseases.withColumn("country_iso3c", F.explode(panel.distinct_values(ev, "country_iso3c")))
        .withColumn("month", F.explode(F.sequence(F.lit(grid_start), F.trunc(F.lit(as_of), "month"), _month())))
    )
    reported_pairs = ev.select("country_iso3c", "disease").distinct().withColumn("_rep", F.lit(True))
    out = (
        grid.join(cells, on=["country_iso3c", "disease", "month"], how="left")
        .join(reported_pairs, on=["country_iso3c", "disease"], how="left")
    )
    if endemic is not None:
        out = out.join(endemic, on=["country_iso3c", "disease", "month"], how="left")
    else:
        out = out.withColumn("endemic", F.lit(None).cast("boolean"))
    single = _in_one_country(ev).withColumn("_single", F.lit(True))
    out = out.join(single, on="disease", how="left")
    start = F.coalesce(F.col("outbreak_start"), F.lit(False))
    sub = F.coalesce(F.col("outbreak_subsequent_month"), F.lit(False))
    end = F.coalesce(F.col("endemic"), F.lit(False))
    suppressed = start & (sub | end)
    out = out.select(
        "country_iso3c",
        "disease",
        "month",
        (start & ~suppressed).alias("outbreak_start"),
        sub.alias("outbreak_subsequent_month"),
        end.alias("endemic"),
        F.col("_rep").isNull().alias("disease_country_combo_unreported"),
        (start | sub).alias("outbreak_ongoing"),
        suppressed.alias("outbreak_start_while_ongoing_or_endemic"),
        F.coalesce(F.col("_single"), F.lit(False)).alias("disease_in_single_country"),
    )
    if remove_single_country:
        out = out.where(~F.col("disease_in_single_country"))
    if primary_diseases is not None:
        prim = primary_diseases.select("disease").distinct().withColumn("disease_primary_taxa", F.lit(True))
        out = out.join(prim, on="disease", how="left").withColumn(
            "disease_primary_taxa", F.coalesce(F.col("disease_primary_taxa"), F.lit(False))
        )
    return out
