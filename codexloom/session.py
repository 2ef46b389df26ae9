"""Session defaults and scratch tables that every executor can reach."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_scratch: list[str] = []


def get_session(app: str = "codexloom", cpus: str | int = "*") -> SparkSession:
    """A local session for tests and benches; on a cluster pass the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CODEXLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


#: Bytes of an Arrow batch; a worker and its executor hold a few at a time, however long the texts are.
ARROW_BATCH = "8m"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Whether a statement's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _default(spark: SparkSession, key: str) -> str:
    """What a session has for a setting if nobody sets it."""
    return spark._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(key)


def let_workers_import(spark: SparkSession) -> SparkSession:
    """Adds the folder of this package to the Python workers' path, for callers that have not installed it, and keeps
    the batches that they get small where the caller has not settled their size."""
    if spark.conf.get(_BATCH_BYTES) == _default(spark, _BATCH_BYTES) and not spark.sparkContext.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, ARROW_BATCH)
    home, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    if home not in (known := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, known) if x)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where that is unset, a folder in the warehouse, which all
    executors reach too; a temporary folder of this machine only if the executors are threads of this process."""
    global _own_dir
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/codexloom-scratch"
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="codexloom-")
    return _own_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the scratch tables made so far; frames that read them can't be used afterwards."""
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        n += int(path.getFileSystem(conf).delete(path, True))
    return n


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df as a Parquet table in the scratch folder: it cuts the lineage and survives a lost executor. What the write has
    shuffled is removed as soon as it is over, not when the driver next collects garbage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
