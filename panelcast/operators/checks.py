"""Declared schemas, checked while a stage is written.

Missing columns raise before anything runs.  Nulls and categories are counted
by ``DataFrame.observe`` in the pass that writes the stage; the uniqueness of the
key is one aggregate over the written key columns.  All problems of a table are
raised together, by name and count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import write_stage


class CheckError(ValueError):
    """A table does not fit its declared schema; ``problems`` has name -> count (or text)."""

    def __init__(self, table: str, problems: dict):
        super().__init__(f"{table}: " + "; ".join(f"{k}: {v}" for k, v in problems.items()))
        self.problems = problems


@dataclass
class TableSchema:
    """What a table must fit."""

    required: list[str]
    key: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    categories: dict[str, list] = field(default_factory=dict)  # null is always allowed here
    ranges: dict[str, tuple] = field(default_factory=dict)  # least and greatest value, None for open

    def missing(self, df: DataFrame) -> list[str]:
        named = {*self.required, *self.key, *self.not_null, *self.categories, *self.ranges}
        return sorted(named - set(df.columns))

    def measures(self) -> dict:
        """Column counts by name of the problem."""
        out = {f"null {c}": F.col(c).isNull() for c in self.not_null}
        out |= {f"category of {c}": ~F.col(c).isin(list(v)) for c, v in self.categories.items()}
        for c, (low, high) in self.ranges.items():
            bad = F.lit(False)
            if low is not None:
                bad = bad | (F.col(c) < low)
            if high is not None:
                bad = bad | (F.col(c) > high)
            out[f"range of {c}"] = bad
        return out


def duplicate_count(df: DataFrame, key: list[str]) -> int:
    """Keys that more than one row has."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()


def problems(counts: dict) -> dict:
    return {k: v for k, v in counts.items() if v}


def checked_stage(df: DataFrame, schema: TableSchema, name: str) -> DataFrame:
    """``df`` written as a stage if it fits ``schema``; ``CheckError`` otherwise."""
    missing = schema.missing(df)
    if missing:
        raise CheckError(name, {"missing columns": ", ".join(missing)})
    measures = schema.measures()
    seen = Observation(f"checks of {name}")
    counts = [F.count_if(c).alias(k) for k, c in measures.items()] + [F.count(F.lit(1)).alias("rows")]
    out = write_stage(df.observe(seen, *counts), name)
    found = problems({k: seen.get[k] for k in measures})
    if schema.key:
        found |= problems({f"repeated key ({', '.join(schema.key)})": duplicate_count(out, schema.key)})
    if found:
        raise CheckError(name, found)
    return out


def null_report(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column_name, n_rows): rows without a value, per column; columns without any are left out."""
    by = by or []
    sums = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return sums.unpivot(by, columns, "column_name", "n_rows").where("n_rows > 0")
