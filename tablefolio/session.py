"""Session defaults, the shared folder and durable cut points."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablefolio")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's `spark.checkpoint.dir`.

    Only a session in local mode may go without one; it gets a scratch folder that is removed at exit. Elsewhere a
    folder on the driver's disk would be unreadable for executors, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tablefolio-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return f"file://{_LOCAL[app]}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` at a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of `df` at a Parquet table in the shared folder: compressed, columnar, read in part."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
