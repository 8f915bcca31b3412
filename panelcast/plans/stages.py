"""Materialised pipeline stages.

Long pipelines are cut at their natural boundaries (rolled-up reports,
lagged panel, monthly outbreak panel, feature and prediction tables): each
stage is written once per session as a Parquet table in the shared
checkpoint folder and read back, so a lost executor replays from the
stage, plans stay small, and several queries reuse one stage.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import write_stage

_MEMO: dict[tuple, DataFrame] = {}
ENABLED = True


def stage(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
    write: Callable[[DataFrame, str], DataFrame] = write_stage,
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if ENABLED and key in _MEMO:
        return _MEMO[key]
    df = write(build(), name)
    if ENABLED:
        _MEMO[key] = df
    return df


def clear() -> None:
    _MEMO.clear()
