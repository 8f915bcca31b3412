"""Named prediction tables, partitioned for reads by disease and month (K3).

A store is a folder of tables that any session can read by name.  Writing
replaces only the partitions that the new rows belong to; reading filters on
the partition columns, so only the files of the wanted partitions are opened.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

PARTITIONS = ["disease", "month"]


def default_root(spark: SparkSession) -> str:
    """``spark.panelcast.store``, or a folder beside the session's stages."""
    return spark.conf.get("spark.panelcast.store", None) or f"{checkpoint_dir(spark).rstrip('/')}/panelcast-store"


class PredictionStore:
    """Tables under ``root``, by name."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, (root or default_root(spark)).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """Replace the partitions that ``df`` has rows of (the whole table without partitions).

        Rows are dealt by partition, so each partition is one file, or several where
        Spark splits a large one (``maxRecordsPerFile``).  The schema is kept beside
        the table: partition values keep their type, whatever they look like.
        """
        schema = self.spark.createDataFrame([(json.dumps(df.schema.jsonValue()),)], "value string")
        schema.coalesce(1).write.mode("overwrite").text(f"{self.root}/_schemas/{name}")
        if partition_by:
            writer = df.repartition(*partition_by).write.partitionBy(*partition_by)
            writer = writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 5_000_000)
        else:
            writer = df.write
        writer.mode("overwrite").parquet(self.path(name))

    def schema(self, name: str) -> T.StructType:
        text = self.spark.read.text(f"{self.root}/_schemas/{name}").first()["value"]
        return T.StructType.fromJson(json.loads(text))

    def read(self, name: str, **only) -> DataFrame:
        """The table, with rows whose columns have one of the values given (``None``: any)."""
        schema = self.schema(name)
        df = self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)
        for column, values in only.items():
            if values is not None:
                df = df.where(F.col(column).isin(list(values)))
        return df

    def names(self) -> list[str]:
        """Names of the stored tables."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_schemas")
        fs = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []
