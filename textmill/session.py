"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app: str = "textmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and Arrow on and UTC time. Cluster
    sizes stay with the submitter; ``master`` is for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of its own."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="textmill-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/textmill/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write a table once and read it back: cuts the lineage, outlives lost
    executors, keeps column pruning, and gives the optimizer its true size. With ``release``
    the shuffle files of the write go when it ends, not when the driver collects its garbage."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP)
    if release:
        conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
