"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}
_SCOPES = threading.local()


def build_session(app: str = "tidewire", master: str | None = None, **conf: str) -> SparkSession:
    """Session for scripts and tests. On a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # local-cluster has executors of its own and is no local mode.
    if spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.TemporaryDirectory(prefix="tidewire-", ignore_cleanup_errors=True)
    return _LOCAL_DIRS[app].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; inside a :func:`scratch_scope` it is deleted when that ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_SCOPES, "paths", None):
        _SCOPES.paths[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what is materialized inside. For jobs that have written their results by the end of it."""
    _SCOPES.paths = [*getattr(_SCOPES, "paths", []), []]
    try:
        yield
    finally:
        for path in _SCOPES.paths.pop():
            delete_path(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a result feeds several branches: the input is scanned once, a lost executor costs no
    recomputation, and the file sizes let Spark decide by itself whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
