"""Taking older files into the lake: normalisers of their shapes, and the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.operators.clean import ALIASES, CANDLE_COLUMNS, PRICES
from bartide.registry import Dataset
from bartide.schemas import BASE_CANDLE
from bartide.session import cut
from bartide.sources import sinks

_EXACT = ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


def _text_or_ms(c: Column) -> Column:
    """A time written as text, or as epoch milliseconds."""
    return F.coalesce(F.when(~c.rlike(r"^\s*\d{9,}\s*$"), c.try_cast("timestamp_ntz")), F.timestamp_millis(c.try_cast("double").cast("long")).cast("timestamp_ntz"))


def _lacking(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def base_candles(df: DataFrame, source: str, ingested_at: str) -> DataFrame:
    """time (text), symbol, prices and volume as candles; rows without time or a price are dropped."""
    df = _lacking(df, dict.fromkeys(("time", "symbol", *PRICES, "volume"), "string"))
    out = df.select(F.col("time").cast("string").try_cast("timestamp_ntz").alias("time"), "symbol", *[F.col(c).try_cast("double").alias(c) for c in (*PRICES, "volume")])
    out = out.withColumns({"source": F.lit(source), "ingested_at": F.lit(ingested_at)})
    return out.dropna(subset=["time", *PRICES]).select(*[f.split()[0] for f in BASE_CANDLE.split(", ")])


def kline_candles(df: DataFrame, source: str, ingested_at: str) -> DataFrame:
    """As ``base_candles``, with the further kline columns under any of their names; time may be open_time, close_time text or milliseconds."""
    for old, new in ALIASES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    if "time" not in df.columns and "open_time" in df.columns:
        df = df.withColumnRenamed("open_time", "time")
    df = _lacking(df, dict.fromkeys(CANDLE_COLUMNS, "string"))
    out = df.select(
        F.col("time").cast("string").try_cast("timestamp_ntz").alias("time"), "symbol", *[F.col(c).try_cast("double").alias(c) for c in (*PRICES, *_EXACT)],
        _text_or_ms(F.col("close_time").cast("string")).alias("close_time"), F.col("number_of_trades").try_cast("double").cast("long").alias("number_of_trades"),
        F.lit(source).alias("source"), F.lit(ingested_at).alias("ingested_at"),
    )
    return out.dropna(subset=["time", *PRICES]).select(*CANDLE_COLUMNS)


def option_snapshots(df: DataFrame, source: str, ingested_at: str) -> DataFrame:
    """Option rows with snapshot_time (or time) and underlying (or the symbol's part before the first dash); others are dropped."""
    if "snapshot_time" not in df.columns and "time" in df.columns:
        df = df.withColumn("snapshot_time", F.col("time"))
    df = _lacking(df, {"snapshot_time": "string", "symbol": "string", "source": "string"})
    if "underlying" not in df.columns:
        df = df.withColumn("underlying", F.split_part("symbol", F.lit("-"), F.lit(1)))
    out = df.withColumns({"snapshot_time": F.col("snapshot_time").cast("string").try_cast("timestamp_ntz"), "source": F.coalesce("source", F.lit(source)), "ingested_at": F.lit(ingested_at)})
    return out.dropna(subset=["snapshot_time", "symbol", "underlying"])


#: By kind of dataset.
NORMALISERS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {"candle": base_candles, "kline": kline_candles, "option": option_snapshots}


def seed(spark: SparkSession, old: DataFrame, root: str, ds: Dataset, kind: str, source: str, ingested_at: str, dry_run: bool = False) -> dict:
    """Older rows (as read from CSV or Parquet, which Spark splits by itself) into the dataset; ``dry_run`` only counts."""
    rows = NORMALISERS[kind](old, source, ingested_at)
    if dry_run:
        r = rows.agg(F.count("*").alias("n"), F.min(ds.time).alias("a"), F.max(ds.time).alias("b"), F.count_distinct(ds.partition).alias("s")).first()
        return {"rows": r.n, "min_time": r.a, "max_time": r.b, "symbols": r.s, "rows_written": 0}
    rows = cut(rows, "seed")
    return sinks.upsert(rows, f"{root}/{ds.path}", ["symbol", ds.time], ds.time, ds.partition, ds.grain)
