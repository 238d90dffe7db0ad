"""Paged REST klines as a Spark data source: one task per symbol and time slice.

There is no network in tests; ``fetch`` is any callable (symbol, start_ms, end_ms, limit) -> list of kline rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.sources.archives import KLINE_COLUMNS


def slices(symbols: list[str], start_ms: int, end_ms: int, slice_ms: int) -> list[tuple[str, int, int]]:
    return [(s, a, min(a + slice_ms, end_ms + 1) - 1) for s in symbols for a in range(start_ms, end_ms + 1, slice_ms)]


def pages(fetch: Callable, symbol: str, start: int, end: int, step_ms: int, limit: int) -> Iterator[list]:
    """Pages from ``start`` on; the cursor moves past the last row's open time."""
    while start <= end:
        rows = fetch(symbol, start, end, limit)
        if not rows:
            return
        yield rows
        last = int(rows[-1][0])
        if last < start or len(rows) < limit:
            return
        start = last + step_ms


def klines(spark: SparkSession, fetch: Callable, symbols: list[str], start_ms: int, end_ms: int, step_ms: int = 60_000, limit: int = 1000, slice_ms: int = 86_400_000) -> DataFrame:
    """Raw kline rows as text, with symbol."""

    def run(batches):
        for pdf in batches:
            for symbol, a, b in pdf.itertuples(index=False):
                for rows in pages(fetch, symbol, a, b, step_ms, limit):
                    yield pd.DataFrame([(symbol, *map(str, r[: len(KLINE_COLUMNS)])) for r in rows], columns=["symbol", *KLINE_COLUMNS])

    todo = slices(symbols, start_ms, end_ms, slice_ms)
    plan = spark.createDataFrame(todo, "symbol string, a long, b long").repartition(max(1, min(len(todo), 1000)), "symbol", "a")
    return plan.mapInPandas(run, "symbol string, " + ", ".join(f"`{c}` string" for c in KLINE_COLUMNS))


def replies(requests: DataFrame, fetch: Callable[[dict], str], tasks: int = 64) -> DataFrame:
    """``requests`` with the reply to each: payload (text) and error, one of them null. ``fetch`` takes a row as a dict.

    A request that fails is a row, not a failed job: the next run asks again for those."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    names = requests.columns

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False, name=None):
                try:
                    rows.append((*r, fetch(dict(zip(names, r))), None))
                except Exception as e:
                    rows.append((*r, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[*names, "payload", "error"])

    return requests.repartition(tasks).mapInPandas(run, f"{kinds}, payload string, error string")


def retrying(fetch: Callable, tries: int = 4, wait_s: float = 1.0, most_wait_s: float = 60.0, sleep: Callable = time.sleep) -> Callable:
    """``fetch`` tried again after a failure, each time twice as long after as before."""

    def run(*args):
        for n in range(tries):
            try:
                return fetch(*args)
            except Exception:
                if n == tries - 1:
                    raise
                sleep(min(wait_s * 2**n, most_wait_s))

    return run


def depth_levels(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A book reply {bids: [[price, quantity], ...], asks: ...} (numbers as text) as arrays of struct<price, qty>, best first; books with an
    empty side are dropped."""
    book = df.withColumn("_j", F.from_json(payload, "bids array<array<string>>, asks array<array<string>>"))
    levels = lambda side: F.transform(f"_j.{side}", lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("qty")))
    out = book.withColumns({"bids": levels("bids"), "asks": levels("asks")}).drop("_j", payload)
    return out.where((F.size("bids") > 0) & (F.size("asks") > 0))


def option_marks(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A reply that is a list of marks or tickers, one row each, numbers as doubles."""
    fields = ("markPrice", "bidIV", "askIV", "markIV", "delta", "theta", "gamma", "vega", "lastPrice", "volume", "bidPrice", "askPrice")
    kind = "array<struct<symbol:string," + ",".join(f"{f}:string" for f in fields) + ">>"
    rows = df.select(*[c for c in df.columns if c != payload], F.explode(F.from_json(payload, kind)).alias("_m"))
    return rows.select(*[c for c in df.columns if c != payload], "_m.symbol", *[F.col(f"_m.{f}").try_cast("double").alias(f) for f in fields]).where("symbol is not null")


def contracts(df: DataFrame, pairs: list[str], kinds: tuple[str, ...] = ("CURRENT_QUARTER", "NEXT_QUARTER"), payload: str = "payload") -> DataFrame:
    """Dated contracts of an exchange's description {symbols: [...]}: of ``kinds``, quoted and margined in USDT, of ``pairs``."""
    kind = "symbols array<struct<symbol:string,pair:string,contractType:string,status:string,quoteAsset:string,marginAsset:string,onboardDate:bigint,deliveryDate:bigint>>"
    s = df.select(F.explode(F.from_json(payload, kind)["symbols"]).alias("s")).select("s.*")
    s = s.where(F.col("contractType").isin(*kinds) & (F.col("quoteAsset") == "USDT") & (F.col("marginAsset") == "USDT") & F.upper("pair").isin([p.upper() for p in pairs]))
    at = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
    return s.select(F.upper("symbol").alias("symbol"), "pair", F.col("contractType").alias("contract_type"), "status", at("onboardDate").alias("onboard_time"), at("deliveryDate").alias("delivery_time"))
