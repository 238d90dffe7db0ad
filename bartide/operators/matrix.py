"""Wide matrices (one column per source) and their long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bartide.operators.clean import keep_last, repair_bounds

FEATURES = ("open", "high", "low", "close", "volume")


def pivot(df: DataFrame, symbols: list[str], value: str, time: str = "time", symbol: str = "symbol") -> DataFrame:
    """Time by symbol, in the order asked for; symbols without rows are null columns. The list is explicit: no pass to find it."""
    return df.groupBy(time).pivot(symbol, symbols).agg(F.max(value))


def unpivot(wide: DataFrame, value: str, time: str = "time", symbol: str = "symbol") -> DataFrame:
    """symbol, time, value of the cells that aren't null."""
    return wide.unpivot([time], [c for c in wide.columns if c != time], symbol, value).where(F.col(value).isNotNull())


def combine_first(new: DataFrame, old: DataFrame, values: list[str], keys: tuple[str, ...] = ("symbol", "time")) -> DataFrame:
    """New values where there are any, else the old; keys of either."""
    n, o = new.select(*keys, *[F.col(v).alias(f"_n_{v}") for v in values]), old.select(*keys, *[F.col(v).alias(f"_o_{v}") for v in values])
    return n.join(o, list(keys), "full").select(*keys, *[F.coalesce(f"_n_{v}", f"_o_{v}").alias(v) for v in values])


def select_symbols(wide: DataFrame, symbols: list[str], time: str = "time") -> DataFrame:
    """The columns asked for, in that order; unknown ones are left out."""
    return wide.select(time, *[s for s in symbols if s in wide.columns])


def ohlcv(matrices: dict[str, DataFrame], time: str = "time", repair: bool = False) -> DataFrame:
    """Long OHLCV of the symbols that all five matrices have; rows with any null are left out."""
    common = reduce(lambda a, b: [c for c in a if c in b], [matrices[f].columns for f in FEATURES])
    long = [unpivot(matrices[f].select(*common), f, time) for f in FEATURES]
    joined = reduce(lambda a, b: a.join(b, ["symbol", time]), long).select(time, "symbol", *FEATURES)
    return repair_bounds(joined) if repair else joined


def merged(new: DataFrame, old: DataFrame | None, universe: DataFrame | None = None) -> DataFrame:
    """A long matrix (symbol, time, features) brought up to date: cells of ``new`` where it has any, else the old ones; symbols of
    ``universe`` (column symbol) only, if given. Long form: a new symbol is rows, not a rewrite of all columns."""
    out = new if old is None else combine_first(new, old, list(FEATURES))
    return out if universe is None else out.join(universe.select("symbol").distinct(), "symbol", "left_semi")


def rebuilt(candles: DataFrame, universe: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """The long daily matrix of the symbols of ``universe`` from daily bars (the last by ``order`` of a day; bounds repaired, rows
    without a price dropped), and the symbols that have none."""
    day = candles.withColumn("time", F.date_trunc("day", F.col("time")).cast("timestamp_ntz"))
    names = universe.select("symbol").distinct()
    kept = keep_last(repair_bounds(day.join(names, "symbol", "left_semi")).dropna(subset=["time", *FEATURES[:4]]), ["symbol", "time"], order)
    return kept.select("symbol", "time", *FEATURES), names.join(kept.select("symbol").distinct(), "symbol", "left_anti")


def write_wide(wide: DataFrame, path: str, time: str = "time") -> None:
    """A matrix as CSV, the date as yyyy-MM-dd in the first column, rows by date: a file for people, one task (days by symbols)."""
    dated = wide.select(F.date_format(time, "yyyy-MM-dd").alias("date"), *[c for c in wide.columns if c != time])
    dated.coalesce(1).sortWithinPartitions("date").write.mode("overwrite").option("header", "true").csv(path)
