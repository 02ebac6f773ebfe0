"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def build_session(app_name: str = "weekgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were planned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one, as tables written there have to outlive any
    executor. Only a local master falls back to a folder on this machine.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="weekgrid-")
    return _local_root[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch root, removed when the application ends."""
    path = f"{scratch_root(spark)}/weekgrid/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_path)  # only a path that exists can be marked for deletion
    files.deleteOnExit(jvm_path)
    return path


def bound_lineage(spark: SparkSession) -> None:
    """Names a folder for the checkpoints of Spark's iterative fits, if none is set.

    Boosting writes its errors there every few rounds; without it each task would
    carry the plan of all rounds before.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a result feeds several scans or an iterative fit. The table
    survives lost executors, and unlike a cached plan it keeps column pruning,
    filter pushdown and size statistics for the join planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
