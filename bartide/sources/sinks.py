"""Writing to the lake: partitioned upsert, retention, rewriting only what changes."""

from __future__ import annotations

import json
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.functions.calendar import trading_hours
from bartide.functions.market import floor_time
from bartide.operators.clean import keep_first, keep_last, repair_bounds
from bartide.session import cut
from bartide.sources import files


def _folders(df: DataFrame, partition: str, time: str, grain: str) -> tuple[DataFrame, list[str]]:
    df = df.withColumn("year", F.year(time))
    names = [partition, "year"]
    if grain == "month":
        df, names = df.withColumn("month", F.month(time)), [*names, "month"]
    return df, names


#: Parameter: up to so many folders a batch's are read by name; a batch that touches more is a bulk load and meets the whole lake.
MOST_FOLDERS = 5_000


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def touched(spark: SparkSession, path: str, new: DataFrame, folders: list[str]) -> DataFrame | None:
    """The rows stored in the folders of ``new``; None if there are none. Other folders are neither listed nor read."""
    wanted = new.select(*folders).distinct()
    few = wanted.limit(MOST_FOLDERS + 1).collect()
    read = spark.read.option("basePath", path)
    if len(few) > MOST_FOLDERS:
        return read.parquet(path).join(wanted, folders, "left_semi")
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    at = ["/".join([path, *[name(f, str(r[f])) for f in folders]]) for r in few]
    at = [p for p in at if files.exists(spark, p)]
    return read.parquet(*at) if at else None


def upsert(new: DataFrame, path: str, keys: list[str], time: str = "time", partition: str = "symbol", grain: str = "month", order: str | None = None) -> dict:
    """Merge ``new`` into the lake at ``path``: per key the row that arrived last stays. Returns rows_written (incoming rows
    with a time, before deduplication) and latest_time.

    Only folders that ``new`` touches are listed, read and rewritten. The merged rows are staged in the shared folder first, as
    a job can't overwrite what it reads; folders then change by dynamic overwrite, so a failed job leaves the old ones.
    ``order``: column of arrival order within ``new`` (ties, and rows of one key without one, are told apart by content)."""
    spark = new.sparkSession
    new = new.where(F.col(time).isNotNull())
    new, folders = _folders(new, partition, time, grain)
    seq = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).cast("long").alias("at")) if order else F.struct(F.lit(True).alias("known"), F.lit(0).cast("long").alias("at"))
    staged = cut(new.withColumn("_seq", F.struct(F.lit(1).alias("gen"), seq.alias("n"))), "upsert-new")
    stats = staged.agg(F.count("*").alias("n"), F.max(time).alias("t")).first()
    if not stats.n:
        return {"rows_written": 0, "latest_time": None}
    both, old = staged, touched(spark, path, staged, folders) if exists(spark, path) else None
    if old is not None:
        for f in folders:  # partition values are read back typed by their names
            old = old.withColumn(f, F.col(f).cast(dict(staged.dtypes)[f]))
        none = F.struct(F.lit(False).alias("known"), F.lit(None).cast("long").alias("at"))
        both = old.withColumn("_seq", F.struct(F.lit(0).alias("gen"), none.alias("n"))).unionByName(staged, allowMissingColumns=True)
    merged = cut(keep_last(both, keys, "_seq").drop("_seq"), "upsert")
    merged.repartition(*folders).sortWithinPartitions(*folders, time).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    return {"rows_written": stats.n, "latest_time": stats.t}


def _rewrite(spark: SparkSession, path: str, kept: DataFrame, changed: DataFrame, folders: list[str]) -> None:
    """Replace the folders listed in ``changed`` by their rows of ``kept``; folders left without rows are deleted."""
    rows = cut(kept.join(changed, folders, "left_semi"), "rewrite")
    emptied = cut(changed.join(rows.select(*folders).distinct(), folders, "left_anti"), "emptied")
    rows.repartition(*folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    jvm = spark.sparkContext._jvm
    for r in emptied.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{f}={r[f]}" for f in folders]]))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def prune(spark: SparkSession, path: str, keep_from, time: str = "time", folders: tuple[str, ...] = ("symbol", "year", "month")) -> dict:
    """Drop rows before ``keep_from``; returns touched folders and removed rows. Folders without old rows aren't rewritten."""
    df = spark.read.parquet(path)
    old = F.col(time) < F.lit(keep_from).cast("timestamp_ntz")
    changed = cut(df.where(old).groupBy(*folders).agg(F.count("*").alias("n")), "prune")
    stats = changed.agg(F.count("*").alias("f"), F.sum("n").alias("n")).first()
    if stats.f:
        _rewrite(spark, path, df.where(~old), changed.drop("n"), list(folders))
    return {"touched": stats.f, "removed": stats.n or 0}


def normalise(spark: SparkSession, path: str, order: str, floor_s: int = 60, folders: tuple[str, ...] = ("symbol", "year", "month")) -> dict:
    """Floor times, repair bounds and deduplicate (symbol, time) in place, folder by folder that needs it."""
    df = spark.read.parquet(path)
    fixed = repair_bounds(df.withColumn("time", floor_time(F.col("time"), floor_s)))
    after = keep_last(fixed, ["symbol", "time"], order)
    off = (F.col("time") != floor_time(F.col("time"), floor_s)) | (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high"))
    before = df.groupBy(*folders).agg(F.count("*").alias("n"), F.count_if(off).alias("off"))
    counted = before.join(after.groupBy(*folders).agg(F.count("*").alias("m")), list(folders))
    changed = cut(counted.where("off > 0 or n <> m"), "normalise")
    stats = changed.agg(F.count("*").alias("f"), F.sum("off").alias("off"), F.sum(F.col("n") - F.col("m")).alias("gone")).first()
    if stats.f:
        _rewrite(spark, path, after, changed.select(*folders), list(folders))
    return {"touched": stats.f, "off_rows": stats.off or 0, "rows_removed": stats.gone or 0}


def cleanse(spark: SparkSession, path: str, order: str, holidays: DataFrame, sessions, folders: tuple[str, ...] = ("symbol", "year", "month")) -> dict:
    """Keep rows within trading hours, and of each (symbol, time) the first by ``order``, in place; folders that change only."""
    df = spark.read.parquet(path)
    after = keep_first(trading_hours(df, "time", holidays, sessions), ["symbol", "time"], order)
    counted = df.groupBy(*folders).agg(F.count("*").alias("n")).join(after.groupBy(*folders).agg(F.count("*").alias("m")), list(folders), "left")
    changed = cut(counted.where("m is null or n <> m"), "cleanse")
    stats = changed.agg(F.count("*").alias("f"), F.sum(F.col("n") - F.coalesce("m", F.lit(0))).alias("gone")).first()
    if stats.f:
        _rewrite(spark, path, after, changed.select(*folders), list(folders))
    return {"touched": stats.f, "removed": stats.gone or 0}


class State:
    """A small JSON document on any file system: written aside and moved; one that can't be read is put aside and counts as empty."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> dict:
        if not files.exists(self.spark, self.path):
            return {}
        try:
            return json.loads(files.text(self.spark, self.path))
        except (ValueError, Py4JJavaError) as e:
            if isinstance(e, Py4JJavaError) and "ChecksumException" not in str(e):
                raise
            files.rename(self.spark, self.path, self.path + ".corrupt")
            return {}

    def write(self, doc: dict) -> dict:
        files.touch(self.spark, self.path + ".tmp", json.dumps(doc, indent=1, sort_keys=True, default=str))
        files.rename(self.spark, self.path + ".tmp", self.path)
        return doc

    def update(self, key: str, **values) -> dict:
        doc = self.read()
        doc.setdefault(key, {}).update({k: v for k, v in values.items() if v is not None})
        return self.write(doc)


class Heartbeat:
    """One small file per job, which says when it last was alive and how it did."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def beat(self, job: str, status: str = "ok", at: datetime | None = None, **details) -> None:
        now = at or datetime.now(timezone.utc).replace(tzinfo=None)
        State(self.spark, f"{self.folder}/{job}.json").write({"job": job, "status": status, "at": now.isoformat(), **details})

    def health(self, most_age_s: dict[str, int], now: datetime | None = None) -> dict[str, str]:
        """By job: ok, failed, stale (older than its ``most_age_s``) or missing."""
        now, out = now or datetime.now(timezone.utc).replace(tzinfo=None), {}
        for job, age in most_age_s.items():
            doc = State(self.spark, f"{self.folder}/{job}.json").read()
            if not doc:
                out[job] = "missing"
            elif (now - datetime.fromisoformat(doc["at"])).total_seconds() > age:
                out[job] = "stale"
            else:
                out[job] = "ok" if doc["status"] == "ok" else "failed"
        return out


@contextmanager
def single_writer(spark: SparkSession, path: str):
    """Exclusive use of a dataset among drivers: a lock file that only one can create. Raises if another has it; a driver that
    dies leaves its file, which says when it began, to be deleted by hand."""
    fs, p = files._at(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if not files.exists(spark, path):
            raise
        raise BlockingIOError(f"{path} is held since {files.text(spark, path)}") from e
    try:
        out.write(bytearray(datetime.now(timezone.utc).isoformat().encode()))
        out.close()
        yield
    finally:
        files.delete(spark, path)
