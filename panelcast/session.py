"""Session construction and lineage management."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(
    master: str | None = None,
    app_name: str = "panelcast",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Session with AQE (coalescing + skew join) and ANSI SQL.

    On a cluster the launcher supplies master / memory / checkpoint dir; only
    unset values are filled here, so this is safe to call from jobs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"  # local mode: the driver JVM runs the tasks
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_STAGES: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    When the setting is absent a private folder is created, but only in local
    mode (tests, benches); on a cluster a machine-local folder would not
    survive executor loss, so an unset value is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One computation (unlike an eager RDD checkpoint without persist), a
    columnar re-read with pushdown, and a lineage cut that survives executor
    loss.
    """
    import uuid

    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/panelcast-stages/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _STAGES.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # known: no job that reads footers
    out._stage_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(hadoop).delete(path, True)


def drop_stage(df: DataFrame) -> None:
    """Delete a stage that ``write_stage`` returned, once what needs it has been written."""
    _STAGES.remove(df._stage_path)
    _delete(df.sparkSession, df._stage_path)


class stage_scope:
    """Deletes the stages written inside it, but for those it is told to keep, when it ends without an error.

    For steps whose result has been written: the operators' own stages are of no use after it.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._kept = spark, set()

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.add(df._stage_path)
        return df

    def __enter__(self) -> stage_scope:
        self._before = set(_STAGES)
        return self

    def __exit__(self, kind, *rest) -> None:
        if kind is None:
            for path in [p for p in _STAGES if p not in self._before and p not in self._kept]:
                _STAGES.remove(path)
                _delete(self._spark, path)


def drop_stages(spark: SparkSession) -> None:
    """Delete the stages that this process has written; frames over them can't be read any more.

    For long-lived sessions, after a result has been stored.
    """
    while _STAGES:
        _delete(spark, _STAGES.pop())


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
