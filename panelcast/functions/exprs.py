"""Column-expression helpers with the null / numeric semantics the domain needs.

All of these return ``Column`` objects built from built-in functions, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- numbers ----------------------------------------------------------------
def parse_int_text(c) -> Column:
    """Text -> integer, truncating decimals, junk -> null ("12.7" -> 12)."""
    return F.expr(f"try_cast(try_cast({_sql(c)} as double) as int)")


def safe_log10(c) -> Column:
    """log10 with -inf at 0 (Spark's log10(0) is null) and null below 0."""
    c = col(c)
    return (
        F.when(c == 0, F.lit(float("-inf")))
        .when(c > 0, F.log10(c))
        .otherwise(F.lit(None).cast("double"))
    )


def safe_div(a, b) -> Column:
    """Division that yields null on a zero divisor instead of raising (ANSI)."""
    return F.try_divide(col(a), col(b))


def is_finite(c) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def strict_agg(agg_fn, c) -> Column:
    """Aggregate that is null as soon as one input is null (R without na.rm)."""
    c = col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), agg_fn(c))


def signif(c, digits: int = 2) -> Column:
    """Round to ``digits`` significant digits (half-even like R)."""
    c = col(c)
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - (digits - 1))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.bround(c / p) * p)


def direction(diff, up: str, down: str, same: str = "no change") -> Column:
    """Three-way label from a signed difference; null stays null."""
    d = col(diff)
    return F.when(d > 0, up).when(d < 0, down).when(d == 0, same)


def all_not_null(cols: Iterable) -> Column:
    return reduce(lambda a, b: a & b, [col(c).isNotNull() for c in cols], F.lit(True))


# ---- status -----------------------------------------------------------------
def status_to_int(c) -> Column:
    """present -> 1, absent/unreported -> 0, anything else -> null."""
    c = col(c)
    return (
        F.when(c == K.STATUS_PRESENT, 1)
        .when(c.isin(K.STATUS_ABSENT, K.STATUS_UNREPORTED), 0)
        .cast("int")
    )


def unreported_marker(c) -> Column:
    return (col(c) == K.STATUS_UNREPORTED).cast("int")


# ---- text -------------------------------------------------------------------
def clean_name(c) -> Column:
    """Lower snake case name (the domain's name cleaner), without dedupe suffix.

    Steps: drop quotes, spell out % and #, transliterate accents, split
    camelCase, lower, runs of non-alphanumerics -> "_", trim "_", prefix "x"
    when the result starts with a digit or is empty.
    """
    s = col(c)
    for a, b in K.CLEAN_NAME_REPLACEMENTS:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.translate(s, "àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇ",
                    "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC")
    s = F.regexp_replace(s, r"([a-z0-9])([A-Z])", "$1_$2")
    s = F.lower(s)
    s = F.regexp_replace(s, r"[^a-z0-9]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.when(s == "", F.lit("x")).when(s.rlike("^[0-9]"), F.concat(F.lit("x"), s)).otherwise(s)


def title_from_snake(c) -> Column:
    return F.initcap(F.regexp_replace(col(c), "_", " "))


def control_flag_columns(text_col, measures=K.CONTROL_MEASURES) -> dict[str, Column]:
    """One 0/1 column per control measure (substring test on the joined text)."""
    t = col(text_col)
    out = {}
    for m in measures:
        name = "control_" + _py_clean(m)
        out[name] = F.coalesce(F.contains(t, F.lit(m)), F.lit(False)).cast("int")
    return out


def _py_clean(s: str) -> str:
    """Python twin of ``clean_name`` for building column names."""
    import re
    import unicodedata

    for a, b in K.CLEAN_NAME_REPLACEMENTS:
        s = s.replace(a, b)
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s).lower()
    s = re.sub(r"[^a-z0-9]+", "_", s).strip("_")
    if not s:
        return "x"
    return "x" + s if s[0].isdigit() else s


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("parse_int_text expects a column name")
