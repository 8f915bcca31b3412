"""Corpus pipeline: five of the training-data operators, one after the other.

Each stage gets the documents that its predecessor kept, written as Parquet in
the session's shared folder and read again, and returns those that it keeps.
The last one returns the mix: the documents with the words taken of each.

Null and empty texts hold no letter and go in the first stage.  Documents with a
null id are kept where an id would be needed to drop them (near copies, leaks);
of equal texts, one with an id stays before one without.  Rows that repeat an id
are one document to the stages that name documents by id.  Extra columns, of any
name, are carried along; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontamination, exact_dedup, language_id, mixing, ngram_join
from panelcast.session import drop_stage, stage_scope, table_path, write_stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without letters go."""
    return language_id.drop_unknown_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    return ngram_join.keep_one_of_each(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: ``mix_taken`` words of each document."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("mix_sources", mix),
]

#: SQL can't express the fitted language classifier; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        with stage_scope(spark) as scope:  # the operators' own stages go once the stage is written
            kept = scope.keep(write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if name != STAGES[0][0]:
            drop_stage(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
