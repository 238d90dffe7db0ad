"""Jobs put together from the operators: gap repair, archive-to-lake sync, audits."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide import validate
from bartide.functions.market import add_seconds, delivery_date, epoch_to_time, floor_time, last_closed
from bartide.operators import clean, gaps, matrix
from bartide.operators.chunks import epoch_us
from bartide.registry import Dataset
from bartide.session import cut
from bartide.sources import archives, lake, sinks
from bartide.sources.rest import pages


def _candles(raw: DataFrame, source: str, ingested_at: str, floor_s: int | None) -> DataFrame:
    """Raw kline text rows of many symbols as candles, the last row per symbol and time."""
    t = epoch_to_time(F.col("open_time").try_cast("long"))
    out = raw.select(
        (floor_time(t, floor_s) if floor_s else t).alias("time"), "symbol", *[F.col(p).try_cast("double").alias(p) for p in (*clean.PRICES, "volume")],
        epoch_to_time(F.col("close_time").try_cast("long")).alias("close_time"), F.col("quote_volume").try_cast("double").alias("quote_volume"),
        F.col("number_of_trades").try_cast("long").alias("number_of_trades"), F.col("taker_buy_base_volume").try_cast("double").alias("taker_buy_base_volume"),
        F.col("taker_buy_quote_volume").try_cast("double").alias("taker_buy_quote_volume"), F.lit(source).alias("source"), F.lit(ingested_at).alias("ingested_at"),
    )
    out = clean.repair_bounds(out).dropna(subset=["time", "symbol", *clean.PRICES]).where("volume is null or volume >= 0")
    return clean.keep_last(out, ["symbol", "time"], "close_time")


def _write(rows: DataFrame, root: str, ds: Dataset) -> dict:
    return sinks.upsert(rows, f"{root}/{ds.path}", ["symbol", ds.time], ds.time, ds.partition, ds.grain)


def _fetched(spark: SparkSession, todo: DataFrame, root: str, ds: Dataset, fetch: Callable, source: str, ingested_at: str) -> dict:
    """Fetch each range of ``todo`` (symbol, from, to), a day at a time, and merge what comes."""
    step, day = ds.step_s or 60, 86_400_000

    def run(batches):
        for pdf in batches:
            for symbol, a, b in pdf.itertuples(index=False):
                for rows in pages(fetch, symbol, a, b, step * 1000, 1000):
                    yield pd.DataFrame([(symbol, *map(str, r[: len(archives.KLINE_COLUMNS)])) for r in rows], columns=["symbol", *archives.KLINE_COLUMNS])

    ms = lambda c: F.expr(f"{c} div 1000")
    days = todo.withColumns({"_a": epoch_us("from"), "_b": epoch_us("to")}).select("symbol", ms("_a").alias("a"), ms("_b").alias("b")).where("a <= b")
    days = days.select("symbol", F.explode(F.sequence("a", "b", F.lit(day))).alias("a"), "b").withColumn("b", F.least(F.col("a") + day - 1, "b"))
    raw = days.repartition(64).mapInPandas(run, "symbol string, " + ", ".join(f"`{c}` string" for c in archives.KLINE_COLUMNS))
    return _write(_candles(raw, source, ingested_at, ds.floor_s), root, ds)


def repair_gaps(
    spark: SparkSession, root: str, ds: Dataset, fetch: Callable, source: str, ingested_at: str, since=None, until=None, most_missing: int | None = None, dry_run: bool = False, max_gaps: int = 0,
    start=None, end=None, symbols: DataFrame | None = None,
) -> dict:
    """Fetch exactly the missing ranges of ``ds`` and merge what comes. Returns gaps, missing, rows_written. With ``start``, ``end``
    and ``symbols`` (see ``gaps.ranges``) what is missing at the ends is a range too; ``since`` and ``until`` bound it."""
    step = ds.step_s or 60
    start = max(start, since) if start is not None and since is not None else start
    end = min(end, until) if end is not None and until is not None else end
    found = gaps.ranges(lake.scan(spark, root, ds, None, since, until, ["symbol", ds.time]), step, start=start, end=end, symbols=symbols, floor_s=ds.floor_s, time=ds.time)
    if most_missing is not None:
        found = found.where(F.col("missing") <= most_missing)
    if max_gaps:  # the first ones only; 0 is all
        found = found.orderBy("symbol", "missing_start").limit(max_gaps)
    found = cut(found, "gaps")
    n = found.agg(F.count("*").alias("gaps"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing")).first()
    if dry_run or not n.gaps:
        return {"gaps": n.gaps, "missing": n.missing, "rows_written": 0}
    wrote = _fetched(spark, found.withColumnsRenamed({"missing_start": "from", "missing_end": "to"}), root, ds, fetch, source, ingested_at)
    return {"gaps": n.gaps, "missing": n.missing, "rows_written": wrote["rows_written"]}


def clipped(todo: DataFrame, symbols: DataFrame, end, step_s: int) -> DataFrame:
    """symbol, from, to: up to ``end``, or to the last period before a contract's delivery if that is earlier."""
    known = symbols.select("symbol", "delivery_time") if "delivery_time" in symbols.columns else symbols.select("symbol", F.lit(None).cast("timestamp_ntz").alias("delivery_time"))
    known = known.groupBy("symbol").agg(F.max("delivery_time").alias("_d"))
    delivery = F.coalesce("_d", delivery_date(F.col("symbol")).cast("timestamp_ntz"))
    last = F.least(F.lit(end).cast("timestamp_ntz"), add_seconds(delivery, -step_s))  # nulls don't count
    return todo.join(known, "symbol", "left").select("symbol", F.col("fetch_from").alias("from"), last.alias("to")).where("from <= to")


def repair_small_gaps(spark: SparkSession, root: str, ds: Dataset, key: Callable, download: Callable, fetch: Callable, source: str, ingested_at: str, most_s: int) -> dict:
    """Gaps of up to ``most_s`` seconds: first from the daily archives of the days they touch, each asked for once (``key(symbol, day)`` gives
    an archive's name as a column), then by fetching what is still missing."""
    step = ds.step_s or 60
    scan = lambda: lake.scan(spark, root, ds, columns=["symbol", ds.time])
    found = cut(gaps.ranges(scan(), step, most_s, floor_s=ds.floor_s, time=ds.time), "gaps")
    days = found.select("symbol", F.explode(F.sequence(F.col("missing_start").cast("date"), F.col("missing_end").cast("date"))).alias("day")).distinct()
    keys = cut(days.select(key(F.col("symbol"), F.col("day")).alias("key")), "keys")
    out = {"gaps": found.count(), "archives": keys.count(), "from_archives": 0, "rejected": 0}
    if not out["gaps"]:
        return out | {"repair": {"gaps": 0, "missing": 0, "rows_written": 0}}
    rows, errors = archives.split_errors(cut(archives.download(keys.repartition(min(out["archives"], 2000)), download, archives.KLINE_COLUMNS), "archives"))
    wrote = _write(_candles(rows.withColumn("symbol", archives.key_parts(F.col("archive"))["symbol"]), source, ingested_at, ds.floor_s), root, ds)
    out |= {"from_archives": wrote["rows_written"], "rejected": errors.count()}
    return out | {"repair": repair_gaps(spark, root, ds, fetch, source, ingested_at, most_missing=most_s // step)}


def fetch_tail(spark: SparkSession, root: str, ds: Dataset, fetch: Callable, source: str, ingested_at: str, start, end, symbols: DataFrame, overlap_s: int = 600) -> dict:
    """Fetch each of ``symbols`` from where ``gaps.resume`` says to ``end``, the last closed period; ``start``: of the backfill.

    A contract that is delivered ends a period before its delivery: ``symbols`` may have delivery_time, else the symbol's own date counts."""
    held = lake.scan(spark, root, ds, columns=["symbol", ds.time]) if sinks.exists(spark, f"{root}/{ds.path}") else spark.createDataFrame([], f"symbol string, `{ds.time}` timestamp_ntz")
    todo = clipped(gaps.resume(held, symbols, start, ds.step_s or 60, overlap_s, time=ds.time), symbols, end, ds.step_s or 60)
    return _fetched(spark, cut(todo, "tail"), root, ds, fetch, source, ingested_at)


def ingest_archives(spark: SparkSession, zips: str, root: str, ds: Dataset, source: str, ingested_at: str) -> dict:
    """All kline archives below ``zips`` into the lake; the symbol is that of the archive's name. ``rejected``: number of archives that are
    damaged, ``rejects`` a few of them; what could be read of them is in the lake."""
    rows, errors = archives.split_errors(cut(archives.read_zips(spark, zips, archives.KLINE_COLUMNS), "archives"))
    rows = rows.withColumn("symbol", archives.key_parts(F.col("archive"))["symbol"])
    wrote = _write(_candles(rows, source, ingested_at, ds.floor_s), root, ds)
    return wrote | {"rejected": errors.count(), "rejects": [tuple(r) for r in errors.orderBy("archive").limit(20).collect()]}


def fill_from(spark: SparkSession, root: str, ds: Dataset, other: Dataset, most_missing: int, context_s: int = 6 * 3600, tag: str = "proxy_fill", ingested_at: str | None = None, **expected) -> dict:
    """Fill gaps of ``ds`` that ``other`` covers completely, volumes and trades scaled by their median ratios around the gap, trades
    rounded half-even. ``ingested_at``: of the fill (now, if not given). Columns that a side lacks are null there.
    ``expected``: start, end and symbols of ``gaps.ranges``, for gaps at the ends."""
    step = ds.step_s or 60
    scaled = ["volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume", "number_of_trades"]
    copied = [*clean.PRICES, "close_time"]

    def side(d: Dataset) -> DataFrame:
        df = lake.scan(spark, root, d)
        lacking = {c: F.lit(None).cast("timestamp_ntz" if c == "close_time" else "double") for c in (*copied, *scaled) if c not in df.columns}
        return df.withColumns(lacking).select("symbol", "time", *copied, *scaled)

    rows = gaps.proxy_fill(side(ds), side(other), step, most_missing, context_s, scaled, copied, tag, **expected)
    rows = rows.withColumns({
        "number_of_trades": F.bround("number_of_trades").cast("long"), "close_time": F.coalesce("close_time", add_seconds(F.col("time"), step - 0.001)),
        "ingested_at": F.lit(ingested_at or datetime.now(timezone.utc).isoformat()),
    })
    return _write(rows, root, ds)


def fetch_archives(spark: SparkSession, root: str, ds: Dataset, listing: Callable, download: Callable, prefixes: list[str], start, end, source: str, ingested_at: str) -> dict:
    """Archives listed below ``prefixes`` whose day or month the lake lacks: list, leave out what is stored, download and take in.

    ``listing(prefix, marker)`` gives a page of the listing, ``download(key)`` an archive's bytes; both run on the executors. A month
    counts as stored if any of its days is."""
    names = spark.createDataFrame([(p,) for p in prefixes], "prefix string").repartition(max(1, len(prefixes)))
    keys = archives.listed(names, listing).where("kind = 'key' and name like '%.zip'").select(F.col("name").alias("key"))
    if sinks.exists(spark, f"{root}/{ds.path}"):
        days = lake.scan(spark, root, ds, columns=["symbol", ds.time]).select("symbol", F.col(ds.time).cast("date").alias("date")).distinct()
        stored = days.union(days.select("symbol", F.trunc("date", "MM"))).distinct()
    else:
        stored = spark.createDataFrame([], "symbol string, date date")
    wanted = cut(archives.wanted_keys(keys, "key", start, end, stored).select("key"), "keys")
    n = wanted.count()
    if not n:
        return {"archives": 0, "rows_written": 0, "latest_time": None, "rejected": 0, "rejects": []}
    raw = cut(archives.download(wanted.repartition(min(n, 2000)), download, archives.KLINE_COLUMNS), "archives")
    rows, errors = archives.split_errors(raw)
    rows = rows.withColumn("symbol", archives.key_parts(F.col("archive"))["symbol"])
    wrote = _write(_candles(rows, source, ingested_at, ds.floor_s), root, ds)
    return {"archives": n, **wrote, "rejected": errors.count(), "rejects": [tuple(r) for r in errors.orderBy("archive").limit(20).collect()]}


def cascade(
    spark: SparkSession, root: str, ds: Dataset, listing: Callable, download: Callable, monthly: list[str], daily: list[str], fetch: Callable, source: str, ingested_at: str,
    start: datetime, now: datetime, symbols: DataFrame, proxy: Dataset | None = None, most_missing: int = 1440, overlap_s: int = 600, state: sinks.State | None = None,
) -> dict:
    """Monthly archives, daily archives, the tail up to the last closed period, normalisation in place, then audit, repair, audit, proxy
    fill, audit. ``symbols``: symbol and perhaps delivery_time. ``state`` keeps the latest time of each run."""
    step = ds.step_s or 60
    end = spark.range(1).select(last_closed(F.lit(now).cast("timestamp_ntz"), step)).first()[0]
    steps = {"monthly": fetch_archives(spark, root, ds, listing, download, monthly, start, end, f"{source}_monthly", ingested_at)}
    steps["daily"] = fetch_archives(spark, root, ds, listing, download, daily, start, end, f"{source}_daily", ingested_at)
    steps["tail"] = fetch_tail(spark, root, ds, fetch, f"{source}_rest", ingested_at, start, end, symbols, overlap_s)
    if not sinks.exists(spark, f"{root}/{ds.path}"):
        return steps | {"audit": {"valid": False, "row_count": 0, "errors": ["no rows"], "info": {}}}
    steps["normalise"] = sinks.normalise(spark, f"{root}/{ds.path}", "close_time", ds.floor_s or step)
    expected = {"start": start, "symbols": symbols.select("symbol")}
    audit = lambda: validate.report(lake.scan(spark, root, ds), ds, **expected)
    steps["audit"] = audit()
    if steps["audit"]["info"].get("gaps"):
        steps["repair"] = repair_gaps(spark, root, ds, fetch, f"{source}_rest", ingested_at, most_missing=most_missing, **expected)
        steps["audit"] = audit()
    if proxy is not None and steps["audit"]["info"].get("gaps"):
        steps["proxy"] = fill_from(spark, root, ds, proxy, most_missing, ingested_at=ingested_at, **expected)
        steps["audit"] = audit()
    if state is not None:
        state.update(ds.name, latest_time=steps["audit"]["info"].get("max_time"), run_at=ingested_at, gaps=steps["audit"]["info"].get("gaps"))
    return steps


def update_matrix(spark: SparkSession, root: str, ds: Dataset, new: DataFrame, universe: DataFrame | None = None) -> dict:
    """Merge new daily bars (symbol, time, features) into a long matrix: new cells where there are any, the old ones else; only the
    years that ``new`` touches are rewritten."""
    path = f"{root}/{ds.path}"
    new = cut(new.where("time is not null and symbol is not null").withColumn("year", F.year("time")), "matrix-new")
    if sinks.exists(spark, path):
        old = sinks.touched(spark, path, new, ["year"])
    else:
        old = None
    out = cut(matrix.merged(new.select("symbol", "time", *matrix.FEATURES), None if old is None else old.select("symbol", "time", *matrix.FEATURES), universe).withColumn("year", F.year("time")), "matrix")
    out.repartition("year", "symbol").sortWithinPartitions("year", "symbol", "time").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    return {"cells": out.count(), "years": [r.year for r in out.select("year").distinct().orderBy("year").collect()]}


def rebuild_matrix(spark: SparkSession, root: str, ds: Dataset, candles: DataFrame, universe: DataFrame, order: str) -> dict:
    """The matrix anew from daily bars; symbols of the universe without any are reported."""
    long, missing = matrix.rebuilt(candles, universe, order)
    long.withColumn("year", F.year("time")).repartition("year", "symbol").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(f"{root}/{ds.path}")
    return {"missing_symbols": [r.symbol for r in missing.orderBy("symbol").collect()]}  # of the universe, a list of names


def sync(
    spark: SparkSession, zips: str, root: str, ds: Dataset, fetch: Callable | None, source: str, ingested_at: str, proxy: Dataset | None = None, most_missing: int = 1440,
    start: datetime | None = None, end: datetime | None = None, symbols: list[str] | None = None, overlap_s: int = 600,
) -> dict:
    """Archives, then the tail, then gap repair, then proxy fill; a report after each step.

    ``start`` and ``end``: the first and last period expected of every symbol in the lake and of ``symbols``. What is missing there
    is repaired, filled and reported as a gap; with both, the tail is fetched (``gaps.resume``) up to ``end``."""
    steps = {"archives": ingest_archives(spark, zips, root, ds, source, ingested_at)}
    exists = lambda: sinks.exists(spark, f"{root}/{ds.path}")
    names = spark.createDataFrame([(s,) for s in symbols or []], "symbol string")
    if exists():
        names = names.union(lake.scan(spark, root, ds, columns=["symbol"])).distinct()
    names = cut(names, "symbols")
    if fetch is not None and start is not None and end is not None:
        steps["tail"] = fetch_tail(spark, root, ds, fetch, source, ingested_at, start, end, names, overlap_s)
    if not exists():
        return steps | {"audit": {"valid": False, "row_count": 0, "errors": ["no rows"], "info": {}}}
    expected = {"start": start, "end": end, "symbols": names} if start is not None or end is not None else {}
    audit = lambda: validate.report(lake.scan(spark, root, ds), ds, **expected)
    steps["audit"] = audit()
    if fetch is not None and steps["audit"]["info"].get("gaps"):
        steps["repair"] = repair_gaps(spark, root, ds, fetch, source, ingested_at, most_missing=most_missing, **expected)
        steps["audit"] = audit()
    if proxy is not None and steps["audit"]["info"].get("gaps"):
        steps["proxy"] = fill_from(spark, root, ds, proxy, most_missing, ingested_at=ingested_at, **expected)
        steps["audit"] = audit()
    return steps
