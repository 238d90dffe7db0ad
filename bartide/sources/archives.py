"""ZIP archives of klines and book depth, unpacked on the executors, and their keys."""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of kline archives, in order.
KLINE_COLUMNS = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore"]
DEPTH_COLUMNS = ["timestamp", "percentage", "depth", "notional"]


def read_zips(spark: SparkSession, path: str, columns: list[str], rows_at_once: int = 50_000) -> DataFrame:
    """Rows of all CSV members below ``path`` as text columns, with archive and error. A first line that isn't a number is a header;
    columns are then taken by its names. Members are streamed, never held whole.

    An archive that is damaged gives one row with an error and no values beside what could be read of it: see ``split_errors``."""

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    unpack = _unpacker(columns, rows_at_once)

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                yield from unpack(name, lambda content=content: content)

    return found.mapInPandas(run, _zip_schema(columns))


def download(keys: DataFrame, fetch: Callable[[str], bytes], columns: list[str], rows_at_once: int = 50_000) -> DataFrame:
    """As ``read_zips``, of the archives named by ``keys`` (column key), which ``fetch`` gets on the executors."""
    unpack = _unpacker(columns, rows_at_once)

    def run(batches):
        for pdf in batches:
            for name in pdf["key"]:
                yield from unpack(name, lambda name=name: fetch(name))

    return keys.select("key").mapInPandas(run, _zip_schema(columns))


def _zip_schema(columns: list[str]) -> str:
    return "archive string, " + ", ".join(f"`{c}` string" for c in columns) + ", error string"


def _unpacker(columns: list[str], rows_at_once: int):
    """A function of an archive's name and of one that gives its bytes, to frames of its rows."""
    names_of_rows = ["archive", *columns, "error"]

    def rows(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for member in z.namelist():
                if not member.endswith(".csv"):
                    continue
                with z.open(member) as f:
                    names = None
                    for line in csv.reader(io.TextIOWrapper(f, "utf-8")):
                        if names is None:
                            head = bool(line) and not line[0][:1].isdigit()
                            names = [{"count": "number_of_trades", "taker_buy_volume": "taker_buy_base_volume"}.get(n.strip(), n.strip()) for n in line] if head else columns
                            if head:
                                continue
                        got = dict(zip(names, line))
                        yield tuple(got.get(c) for c in columns)

    def unpack(name: str, content: Callable[[], bytes]):
        part: list[tuple] = []
        try:
            for r in rows(content()):
                part.append((name, *r, None))
                if len(part) >= rows_at_once:
                    yield pd.DataFrame(part, columns=names_of_rows)
                    part = []
        except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, csv.Error, NotImplementedError, RuntimeError, OSError) as e:
            part.append((name, *[None] * len(columns), f"{type(e).__name__}: {e}"))
        if part:
            yield pd.DataFrame(part, columns=names_of_rows)

    return unpack


def split_errors(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_zips``, and its rejects (archive, error). Each is one pass: cut ``raw`` first where both are wanted."""
    return raw.where("error is null").drop("error"), raw.where("error is not null").select("archive", "error")


def listing(fetch: Callable[[str, str], str], prefix: str) -> Iterator[tuple[str, str]]:
    """(kind, name) of all keys and common prefixes of an object store's listing in XML, page by page from a marker;
    ``fetch(prefix, marker)`` returns a page."""
    marker = ""
    while True:
        root = ElementTree.fromstring(fetch(prefix, marker))
        space = root.tag.split("}")[0] + "}" if root.tag.startswith("{") else ""
        text = lambda node, name: (node.findtext(f"{space}{name}") or "").strip()
        keys = [text(c, "Key") for c in root.findall(f"{space}Contents")]
        folders = [text(c, "Prefix") for c in root.findall(f"{space}CommonPrefixes")]
        yield from (("key", k) for k in keys)
        yield from (("prefix", f) for f in folders)
        following = text(root, "NextMarker") or max([*keys, *folders], default="")
        if text(root, "IsTruncated").lower() != "true" or not following or following == marker:
            return
        marker = following


def listed(prefixes: DataFrame, fetch: Callable[[str, str], str]) -> DataFrame:
    """prefix, kind, name: the listings of ``prefixes`` (column prefix), fetched on the executors."""

    def run(batches):
        for pdf in batches:
            for p in pdf["prefix"]:
                rows = [(p, kind, name) for kind, name in listing(fetch, p)]
                yield pd.DataFrame(rows, columns=["prefix", "kind", "name"])

    return prefixes.select("prefix").mapInPandas(run, "prefix string, kind string, name string")


def key_parts(key: Column) -> dict[str, Column]:
    """symbol, interval and date (a month's first day for monthly archives) of a key like .../SYMBOL-1m-2024-03[-15].zip."""
    pattern = r"([A-Z0-9_]+)-(\w+)-(\d{4}-\d{2}(?:-\d{2})?)\.zip$"
    day = F.regexp_extract(key, pattern, 3)
    return {
        "symbol": F.nullif(F.regexp_extract(key, pattern, 1), F.lit("")), "interval": F.nullif(F.regexp_extract(key, pattern, 2), F.lit("")),
        "date": F.when(F.length(day) == 7, F.concat(day, F.lit("-01"))).otherwise(day).try_cast("date"),
    }


def wanted_keys(keys: DataFrame, key: str, start, end, stored: DataFrame) -> DataFrame:
    """Keys of days in [start, end], and of months from that of ``start`` to that of ``end``, whose date ``stored`` (symbol, date) lacks."""
    day = lambda x: F.lit(x).cast("date")
    dated = keys.withColumns(key_parts(F.col(key))).withColumn("_monthly", F.col(key).rlike(r"-\d{4}-\d{2}\.zip$") & ~F.col(key).rlike(r"-\d{4}-\d{2}-\d{2}\.zip$"))
    since = F.when(F.col("_monthly"), F.trunc(day(start), "MM")).otherwise(day(start))
    dated = dated.where((F.col("date") >= since) & (F.col("date") <= day(end))).drop("_monthly")
    return dated.join(stored.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
