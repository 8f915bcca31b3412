"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each Spark builder takes (spark, sf_dir) and returns a DataFrame over the
whole input tables; calling it may write stages and fit parameters.
``comparable`` gives a query's result the way its oracle SQL does (integers
-> bigint, doubles rounded to 4 places); the queries themselves don't round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def comparable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query with integers as bigint and doubles rounded to 4 places, as its SQL gives them."""
    query = QUERIES[name]
    if name not in ORACLES:
        return query

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _final(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def _final(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 4)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        queries_features,
        queries_misc,
        queries_models,
        queries_network,
        queries_nowcast,
        queries_readside,
    )
