"""Readers for source tables (Parquet by default) and lookup CSVs.

Readers stay lazy: projection and filters written after them are pushed into
the Parquet scan by Catalyst (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_lookup_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV lookup read (quoted fields with commas allowed, gz accepted)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


LOOKUP_SCHEMAS = {
    "disease_recode": T.StructType(
        [T.StructField("disease", T.StringType()), T.StructField("disease_recode", T.StringType())]
    ),
    "disease_recode_rare": T.StructType(
        [
            T.StructField("disease", T.StringType()),
            T.StructField("disease_recode", T.StringType()),
            T.StructField("disease_recode_rare", T.StringType()),
        ]
    ),
    "disease_taxa": T.StructType(
        [
            T.StructField("disease", T.StringType()),
            T.StructField("disease_pre_clean", T.StringType()),
            T.StructField("taxa", T.StringType()),
        ]
    ),
    "countries": T.StructType(
        [T.StructField("country", T.StringType()), T.StructField("country_iso3c", T.StringType())]
    ),
    "nowcast_split": T.StructType(
        [
            T.StructField("country_iso3c", T.StringType()),
            T.StructField("taxa", T.StringType()),
            T.StructField("disease", T.StringType()),
            T.StructField("disease_population", T.StringType()),
            T.StructField("report_year", T.IntegerType()),
            T.StructField("report_semester", T.IntegerType()),
            T.StructField("validation_set", T.BooleanType()),
        ]
    ),
    "network_split": T.StructType(
        [
            T.StructField("country_iso3c", T.StringType()),
            T.StructField("disease", T.StringType()),
            T.StructField("month", T.DateType()),
            T.StructField("validation_set", T.BooleanType()),
        ]
    ),
}
