"""Small operations on whichever file system a path belongs to. Listings are of one folder and hold names only."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file, in place of one that is there."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def upload(spark: SparkSession, local: str, path: str) -> None:
    """Copy a file of the driver's machine to ``path``."""
    fs, p = _at(spark, path)
    fs.copyFromLocalFile(False, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file:{local}"), p)


def text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; what lies at ``new`` is replaced."""
    fs, p = _at(spark, old)
    _, q = _at(spark, new)
    fs.delete(q, True)
    fs.rename(p, q)
