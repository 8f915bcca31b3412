"""Semester / month period arithmetic.

One integer ``period_idx = year*2 + (semester-1)`` orders semesters; the
textual ``20051`` and decimal ``2005.5`` codes of the domain are derived.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col


def period_idx(year="report_year", semester="report_semester") -> Column:
    return col(year) * 2 + (col(semester) - 1)


def year_of_period(p) -> Column:
    return F.floor(col(p) / 2).cast("int")


def semester_of_period(p) -> Column:
    return (F.pmod(col(p), F.lit(2)) + 1).cast("int")


def semester_of_month(d) -> Column:
    return F.when(F.month(col(d)) < 7, 1).otherwise(2).cast("int")


def period_code(year="report_year", semester="report_semester") -> Column:
    """20051-style code."""
    return (col(year) * 10 + col(semester)).cast("int")


def decimal_period(year="report_year", semester="report_semester") -> Column:
    """2005.0 / 2005.5 style code."""
    return col(year) + (col(semester) - 1) / 2.0


def semester_months(year="report_year", semester="report_semester") -> Column:
    """Array of the six first-of-month dates of a semester."""
    start = F.make_date(col(year), (col(semester) - 1) * 6 + 1, F.lit(1))
    end = F.make_date(col(year), (col(semester) - 1) * 6 + 6, F.lit(1))
    return F.sequence(start, end, F.expr("interval 1 month"))


def month_floor(d) -> Column:
    return F.trunc(col(d), "month")


def as_date(value) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def period_of_date(d: dt.date) -> int:
    return d.year * 2 + (0 if d.month < 7 else 1)
