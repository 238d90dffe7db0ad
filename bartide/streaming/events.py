"""Market events as Structured Streaming: parsing, bars, deduplication, upsert, gap detection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bartide.functions.market import stream_price
from bartide.schemas import COMMON_EVENT, EVENTS
from bartide.sources import sinks

#: Boards of a subscription by default.
BOARDS = ["G1", "G3", "G4", "G7", "T1", "T2", "T3", "T4", "T6"]


def parsed(raw: DataFrame, event: str, payload: str = "payload") -> DataFrame:
    """The messages of one event, typed; works on streams and tables alike."""
    codes, fields = EVENTS[event]
    rows = raw.withColumn("_m", F.from_json(F.col(payload), f"{COMMON_EVENT}, {fields}")).where(F.col("_m.T").isin(codes))
    out = rows.select("_m.*", *[c for c in ("received_at",) if c in raw.columns])
    return out.withColumn("time", event_time(F.col("time")))


def event_time(text: Column) -> Column:
    """A stream's time field (ISO text, or epoch seconds, ms or us) as TIMESTAMP."""
    n = text.try_cast("double")
    scaled = F.when(n < 1e11, n * 1e6).when(n < 1e14, n * 1e3).otherwise(n)
    return F.coalesce(F.timestamp_micros(scaled.cast("long")), text.try_cast("timestamp"))


def subscribed(df: DataFrame, symbols: list[str] | None = None, boards: list[str] | None = None) -> DataFrame:
    if symbols is not None:
        df = df.where(F.col("symbol").isin([s.strip().upper() for s in symbols]))
    return df.where(F.col("boardId").isin(boards)) if boards is not None else df


def book_edges(quotes: DataFrame) -> DataFrame:
    """best_bid, best_ask, spread of quote events; null on an empty side."""
    bid, ask = F.try_element_at("bid", F.lit(1))["price"], F.try_element_at("offer", F.lit(1))["price"]
    return quotes.withColumns({"best_bid": bid, "best_ask": ask, "spread": ask - bid})


def bars(ticks: DataFrame, seconds: int, lateness: str, symbol: str = "symbol", time: str = "time", price: str = "price", volume: str = "volume", order: str = "seq") -> DataFrame:
    """Tumbling bars of a tick stream (NTZ times are read as UTC). Bars close when the watermark passes them."""
    t = ticks.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", lateness)
    at = F.struct(F.col("_t"), F.col(order))
    g = t.groupBy(F.window("_t", f"{seconds} seconds"), F.col(symbol).alias("symbol"))
    out = g.agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("n"))
    return out.select("symbol", F.col("window.start").cast("timestamp_ntz").alias("time"), "open", "high", "low", "close", "volume", "n")


def deduplicated(stream: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """The first event of each key within the lateness."""
    t = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", lateness)
    return t.dropDuplicatesWithinWatermark(keys).drop("_t")


def upsert_to(path: str, keys: list[str], **options):
    """A foreachBatch function: idempotent by key, so replays after a failure change nothing."""

    def write(batch: DataFrame, _: int) -> None:
        sinks.upsert(batch, path, keys, **options)

    return write


def gap_events(stream: DataFrame, step_s: int, symbol: str = "symbol", time: str = "time") -> DataFrame:
    """(symbol, prev_s, next_s) whenever a source's next reading comes more than ``step_s`` after its latest; late readings open no gap.

    State is one number per source. Readings are reduced to whole seconds in arrow batches, by arrays: a busy source costs a few
    bytes a reading and no Python per reading."""

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        latest = state.get[0] if state.exists else None
        seconds = np.zeros(0, np.int64)
        for pdf in pdfs:
            seconds = np.union1d(seconds, pdf["_s"].to_numpy(np.int64))  # distinct and sorted
        if latest is not None:
            seconds = np.append(latest, seconds[seconds > latest])
        if len(seconds):
            state.update((int(seconds[-1]),))
        at = np.flatnonzero(np.diff(seconds) > step_s)
        yield pd.DataFrame({"symbol": [key[0]] * len(at), "prev_s": seconds[at], "next_s": seconds[at + 1]})

    timed = stream.where(F.col(time).isNotNull() & F.col(symbol).isNotNull()).select(F.col(symbol).alias("symbol"), F.unix_seconds(F.col(time).cast("timestamp")).alias("_s"))
    return timed.groupBy("symbol").applyInPandasWithState(run, "symbol string, prev_s long, next_s long", "latest long", "append", GroupStateTimeout.NoTimeout)


def stream_bars(bars: DataFrame) -> DataFrame:
    """Bar events with their prices as bars have them: two decimals, half to even, 0 where there is none."""
    return bars.withColumns({c: stream_price(F.col(c)) for c in ("open", "high", "low", "close")})


def run_every(stream: DataFrame, checkpoint: str, seconds: int, batch):
    """A polling loop: ``batch`` every ``seconds``; the running query, to be awaited or stopped."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").foreachBatch(batch).start()


def run_available(stream: DataFrame, checkpoint: str, path: str | None = None, batch=None, mode: str = "append") -> None:
    """Process what there is and stop: to Parquet at ``path``, or through ``batch`` (foreachBatch)."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = (w.foreachBatch(batch) if batch else w.format("parquet").option("path", path)).start()
    q.awaitTermination()
