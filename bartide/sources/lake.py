"""Reading a Hive-partitioned lake of candles, features and snapshots.

Time bounds become filters on time and on the year and month folders, so other folders
aren't listed or read. Parquet is read by name. CSV is read as text, file group by
header, and cast with try_cast: Spark maps CSV columns by position, and drifting headers
would swap them silently."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.registry import Dataset
from bartide.session import cut
from bartide.sources import files


def folder_filter(grain: str, start: datetime | None, end: datetime | None) -> Column | None:
    """The year and month folders that [start, end] touches."""
    year, month = F.col("year").cast("int"), F.col("month").cast("int")
    tests = []
    for bound, later in ((start, True), (end, False)):
        if bound is None or grain == "none":
            continue
        beyond = year > bound.year if later else year < bound.year
        if grain == "month":
            inside = month >= bound.month if later else month <= bound.month
            tests.append(beyond | ((year == bound.year) & inside))
        else:
            tests.append(beyond | (year == bound.year))
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


def symbol_list(symbols: str | list[str] | None) -> list[str] | None:
    """Trimmed upper-case names; None is all."""
    if symbols is None:
        return None
    return [s.strip().upper() for s in ([symbols] if isinstance(symbols, str) else symbols)]


def _stored(spark: SparkSession, path: str, partition: str, symbols: list[str]) -> list[str]:
    """The folder of each symbol: in capitals if there is one, else as written, else in small letters."""
    held = {unquote(n.split("=", 1)[1]) for n in files.names(spark, path) if n.startswith(f"{partition}=")}
    variants = [(s.strip().upper(), s.strip(), s.strip().lower()) for s in symbols]
    return [next((v for v in vs if v in held), vs[0]) for vs in variants]


def scan(spark: SparkSession, root: str, ds: Dataset, symbols: str | list[str] | None = None, start: datetime | None = None, end: datetime | None = None, columns: list[str] | None = None) -> DataFrame:
    """The rows of ``ds`` with start <= time <= end, lazily; only the folders and columns needed are read."""
    df = spark.read.parquet(f"{root}/{ds.path}")
    if symbols is not None:
        df = df.where(F.col(ds.partition).isin(_stored(spark, f"{root}/{ds.path}", ds.partition, [symbols] if isinstance(symbols, str) else symbols)))
    folders = folder_filter(ds.grain, start, end)
    if folders is not None:
        df = df.where(folders)
    df = between(df, ds.time, start, end)
    return df.select(*columns) if columns else df


def between(df: DataFrame, time: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with start <= time <= end, either bound being optional."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    return df if end is None else df.where(F.col(time) <= F.lit(end).cast("timestamp_ntz"))


def of_symbols(df: DataFrame, symbols: str | list[str] | None, column: str = "symbol") -> DataFrame:
    names = symbol_list(symbols)
    return df if names is None else df.where(F.upper(column).isin(names))


def discover(spark: SparkSession, root: str, ds: Dataset) -> DataFrame:
    """The symbols there are: a scan of folders only."""
    return spark.read.parquet(f"{root}/{ds.path}").select(F.upper(ds.partition).alias("symbol")).distinct()


def latest(spark: SparkSession, root: str, ds: Dataset) -> DataFrame:
    """The latest time by symbol."""
    return extent(spark.read.parquet(f"{root}/{ds.path}"), ds.partition, ds.time).select("symbol", "latest_time")


def times(df: DataFrame, alternates: tuple[str, ...] = ("time", "open_time", "snapshot_time"), symbol: str = "symbol") -> DataFrame:
    """symbol, time: nothing but the time of each row, under whichever of ``alternates`` the table has it (the first that isn't null)."""
    held = [c for c in alternates if c in df.columns]
    if not held:
        raise ValueError(f"none of {', '.join(alternates)} among the columns")
    return df.select(F.col(symbol).alias("symbol"), F.coalesce(*[F.col(c).cast("timestamp_ntz") for c in held]).alias("time"))


def extent(df: DataFrame, symbol: str = "symbol", time: str = "time") -> DataFrame:
    """symbol, latest_time, first_time, n."""
    return df.groupBy(F.col(symbol).alias("symbol")).agg(F.max(time).alias("latest_time"), F.min(time).alias("first_time"), F.count("*").alias("n"))


def _headers(batches):
    """Of each file (path) its first line, or why it can't be read."""
    from pyarrow import fs

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            try:
                store, at = fs.FileSystem.from_uri(unquote(path))
                with store.open_input_stream(at, compression="gzip" if at.endswith(".gz") else None) as f:
                    text, more = b"", b"x"
                    while more and b"\n" not in text:
                        text += (more := f.read(1 << 16))
                    if at.endswith(".gz"):
                        while f.read(1 << 20):  # a damaged archive fails at its end
                            pass
                rows.append((path, text.split(b"\n", 1)[0].decode("utf-8-sig").strip("\r"), None))
            except Exception as e:
                rows.append((path, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["path", "header", "error"])


def csv_files(spark: SparkSession, root: str) -> DataFrame:
    """path, header, error of all .csv and .csv.gz files below ``root``; only first lines are read (of archives, all, to see that they are whole)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,csv.gz}").load(root).select("path")
    return found.mapInPandas(_headers, "path string, header string, error string")


def csv_by_header(spark: SparkSession, root: str, columns: dict[str, str], aliases: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All .csv and .csv.gz files below ``root`` as ``columns`` (name to type), one read per header; and the files that can't be
    read (path, error), which are skipped. Files without a byte are none.

    Lacking columns are null, values that can't be cast too. Names of files reach the driver header by header, as they do in
    any read of them; rows never do."""
    listed = cut(csv_files(spark, root), "headers")
    out = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in columns.items()))
    for g in listed.where("header is not null").select("header").distinct().orderBy("header").toLocalIterator():
        names = [(aliases or {}).get(n.strip().strip('"'), n.strip().strip('"')) for n in g.header.split(",")]
        schema = ", ".join(f"`{n}` string" for n in names)
        paths = [unquote(r.path) for r in listed.where(F.col("header") == g.header).select("path").orderBy("path").collect()]
        part = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").csv(paths)
        part = part.select(*[(F.col(f"`{c}`").try_cast(t) if c in names else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])
        out = out.unionByName(part)
    return out, listed.where("error is not null").select("path", "error")


def wide_csv(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A matrix file (first column the date, then one per symbol) in long form: symbol, time, value."""
    wide = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    first, rest = wide.columns[0], wide.columns[1:]
    typed = wide.select(F.col(f"`{first}`").try_cast("date").alias("time"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in rest])
    return typed.unpivot(["time"], rest, "symbol", value).where(F.col(value).isNotNull() & F.col("time").isNotNull())
