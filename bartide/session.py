"""Session configuration and the shared working folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this engine relies on; a cluster may set the rest.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "bartide", **conf: str) -> SparkSession:
    """A session with this engine's settings; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where neither that setting nor a checkpoint directory exists, and all tasks
    run in this process (tests), is one chosen here; on a cluster that raises.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file:///tmp/bartide-shared-{os.getpid()}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_PATHS: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; deleted when the driver's Python ends, as results may be read until then."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _PATHS.append(path)
    return path


def _delete(path: str) -> None:
    if path.startswith(("file:", "/")):
        shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
    elif (sc := SparkContext._active_spark_context) is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _delete_work() -> None:
    for path in _PATHS:
        try:
            _delete(path)
        except Exception:  # the session may be gone already
            return


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there
    and the rows survive the loss of any executor."""
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``cut`` wrote for ``df``, when nothing will read it again: rounds don't pile up in the shared folder."""
    _delete(df._cut_path)
    _PATHS.remove(df._cut_path)
