"""Normalising, deduplicating and repairing candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bartide.functions.market import epoch_to_time, floor_time, last_closed, no_nan, strict_greatest, strict_least

PRICES = ("open", "high", "low", "close")
#: Other names of candle columns.
ALIASES = {
    "count": "number_of_trades", "taker_buy_volume": "taker_buy_base_volume", "quote_asset_volume": "quote_volume",
    "taker_buy_base_asset_volume": "taker_buy_base_volume", "taker_buy_quote_asset_volume": "taker_buy_quote_volume",
}
CANDLE_COLUMNS = ("time", "symbol", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "source", "ingested_at")


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one that arrived last (largest ``order``). A max per key, combined before the shuffle.

    Rows without an order stay only where their key has no other; ties are broken by content."""
    known = F.col(order).isNotNull()
    return _keep(df, keys, F.max_by(F.struct(*df.columns), F.struct(known, order, _content(df))))


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """As ``keep_last``, the smallest ``order``."""
    unknown = F.col(order).isNull()
    return _keep(df, keys, F.min_by(F.struct(*df.columns), F.struct(unknown, order, _content(df))))


def _content(df: DataFrame) -> Column:
    return F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def _keep(df: DataFrame, keys: list[str], best: Column) -> DataFrame:
    kept = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best.alias("_r"))
    return kept.select("_r.*")


def repair_bounds(df: DataFrame) -> DataFrame:
    """high and low widened to hold open and close; null where any of the four is."""
    o, h, lo, c = (no_nan(F.col(k).cast("double")) for k in PRICES)
    return df.withColumns({"open": o, "close": c, "high": strict_greatest(o, h, lo, c), "low": strict_least(o, h, lo, c)})


def numeric(df: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    """Columns cast, what can't be read as null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in columns})


def klines(df: DataFrame, symbol: str, source: str, ingested_at: str, floor_s: int | None = 60) -> DataFrame:
    """Raw kline rows (open_time in epoch ms or us, numbers as text) as candles.

    Columns under other names are renamed, lacking ones are null; rows without time or a price are dropped;
    bounds are repaired; of rows at one time the last (by close_time) stays."""
    for old, new in ALIASES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    opened = epoch_to_time(F.col("open_time").try_cast("long"))
    col = lambda n, kind: F.col(n).try_cast(kind) if n in df.columns else F.lit(None).cast(kind)
    out = df.select(
        (floor_time(opened, floor_s) if floor_s else opened).alias("time"), F.lit(symbol).alias("symbol"), *[col(p, "double").alias(p) for p in PRICES],
        col("volume", "double").alias("volume"), epoch_to_time(col("close_time", "long")).alias("close_time"), col("quote_volume", "double").alias("quote_volume"),
        col("number_of_trades", "long").alias("number_of_trades"), col("taker_buy_base_volume", "double").alias("taker_buy_base_volume"),
        col("taker_buy_quote_volume", "double").alias("taker_buy_quote_volume"), F.lit(source).alias("source"), F.lit(ingested_at).alias("ingested_at"),
    )
    return keep_last(repair_bounds(out).dropna(subset=["time", *PRICES]), ["time"], "close_time")


def ohlc_columns(df: DataFrame, payload: str) -> DataFrame:
    """A JSON object of parallel arrays {t, o, h, l, c, v} (t in epoch seconds) as one row per bar."""
    kind = "struct<t:array<bigint>,o:array<double>,h:array<double>,l:array<double>,c:array<double>,v:array<double>>"
    parsed = df.withColumn("_j", F.from_json(payload, kind))
    bars = parsed.select(*[c for c in df.columns if c != payload], F.inline(F.arrays_zip("_j.t", "_j.o", "_j.h", "_j.l", "_j.c", "_j.v")))
    return bars.withColumnsRenamed({"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}).withColumn("time", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")


def ohlc_rows(df: DataFrame, payload: str) -> DataFrame:
    """A JSON object with an array of bars under data, candles or ohlc, whose fields go by long or short names, as one row per
    bar; a time is epoch seconds or text. Texts that can't be read are null."""
    bar = "struct<time:string,t:string," + ",".join(f"{n}:string,{n[0]}:string" for n in (*PRICES, "volume")) + ">"
    parsed = df.withColumn("_j", F.from_json(payload, ", ".join(f"{k} array<{bar}>" for k in ("data", "candles", "ohlc"))))
    bars = parsed.select(*[c for c in df.columns if c != payload], F.explode(F.coalesce("_j.data", "_j.candles", "_j.ohlc")).alias("_b"))
    time = F.coalesce("_b.time", "_b.t")
    at = F.coalesce(F.timestamp_seconds(time.try_cast("long")).cast("timestamp_ntz"), time.try_cast("timestamp_ntz"))
    return bars.select(
        *[c for c in df.columns if c != payload], at.alias("time"),
        *[F.coalesce(F.col(f"_b.{n}"), F.col(f"_b.{n[0]}")).try_cast("double").alias(n) for n in (*PRICES, "volume")],
    )


def vendor_bars(df: DataFrame, zone: str) -> DataFrame:
    """Parsed bars (time in UTC) on the wall clock of ``zone``: rows without time or a price are dropped, a lacking volume is 0, a
    negative one drops the row."""
    out = df.withColumns({"time": F.convert_timezone(F.lit("UTC"), F.lit(zone), "time"), "volume": F.coalesce("volume", F.lit(0.0)).cast("long")})
    return out.dropna(subset=["time", *PRICES]).where("volume >= 0")


def daily_batch(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Daily bars of a batch reply, one JSON object per symbol with ``values`` [{datetime, open, ...}]: the last of a day's rows stays."""
    bar = "struct<datetime:string," + ",".join(f"{n}:string" for n in (*PRICES, "volume")) + ">"
    rows = df.select("symbol", F.posexplode(F.from_json(payload, f"values array<{bar}>")["values"]).alias("_at", "_b"))
    bars = rows.select("symbol", F.col("_b.datetime").try_cast("timestamp_ntz").alias("time"), *[F.col(f"_b.{n}").try_cast("double").alias(n) for n in (*PRICES, "volume")], "_at")
    return keep_last(bars.where("time is not null"), ["symbol", "time"], "_at").drop("_at").withColumn("is_closed", F.lit(True))


def closed(df: DataFrame, time: str, now, step_s: int) -> DataFrame:
    """Rows of periods that have ended by ``now``: those up to its period's start less one period."""
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    return df.where(F.col(time) <= last_closed(at, step_s))


def resample(df: DataFrame, symbol: str, time: str, seconds: int, order: str, price: str | None = None, volume: str = "volume") -> DataFrame:
    """Bars of ``seconds``: first, greatest, least, last price and summed volume; ticks (``price``) or finer bars."""
    o, h, lo, c = (price,) * 4 if price else PRICES
    at = F.struct(F.col(time), F.col(order))
    bars = df.withColumn("_bar", floor_time(F.col(time), seconds)).groupBy(F.col(symbol).alias("symbol"), F.col("_bar").alias("time"))
    return bars.agg(F.min_by(o, at).alias("open"), F.max(h).alias("high"), F.min(lo).alias("low"), F.max_by(c, at).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("n"))


def latest_per_bucket(df: DataFrame, keys: list[str], sample_time: str) -> DataFrame:
    """All rows of each key's latest sample (a snapshot may have many rows)."""
    top = df.groupBy(*keys).agg(F.max(sample_time).alias("_latest"))
    return df.join(top.withColumnRenamed("_latest", sample_time), [*keys, sample_time], "left_semi")


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rank over the whole table as a fraction, ties sharing their average rank (null values get null).

    Ranks come from running counts over the distinct values, not from one sorted partition of all rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_c"))
    w = Window.orderBy(column)
    ranks = counts.withColumns({"_upto": F.sum("_c").over(w), "_all": F.sum("_c").over(Window.partitionBy())})
    ranks = ranks.select(column, ((F.col("_upto") - F.col("_c") + (F.col("_c") + 1) / 2) / F.col("_all")).alias(out))
    return df.join(ranks, column, "left")


def scored(df: DataFrame, weights: dict[str, float], out: str = "score") -> DataFrame:
    """The weighted sum of the columns' fractional ranks."""
    names = []
    for i, c in enumerate(weights):
        df = average_rank(df, c, f"_rank{i}")
        names.append(f"_rank{i}")
    total = sum((F.col(n) * w for n, w in zip(names, weights.values())), F.lit(0.0))
    return df.withColumn(out, total).drop(*names)


def stability(df: DataFrame, symbol: str, volume: str, least: int = 90) -> DataFrame:
    """Mean over deviation of log volume, of positive volumes; 0 with fewer than ``least`` of them."""
    v = F.when(F.col(volume) > 0, F.log1p(F.col(volume)))
    stats = df.groupBy(symbol).agg(F.count(v).alias("n"), (F.avg(v) / (F.stddev_samp(v) + 1e-9)).alias("_s"))
    return stats.select(symbol, "n", F.when(F.col("n") < least, 0.0).otherwise(F.coalesce("_s", F.lit(0.0))).alias("stability"))
