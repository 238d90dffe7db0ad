"""Option-chain snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bartide.functions.market import option_part


def parsed(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Add underlying, expiry, strike, type; rows of another form are dropped."""
    s = F.col(symbol)
    out = df.withColumns({"underlying": option_part(s, 1), "expiry": F.try_to_date(option_part(s, 2), "yyMMdd"), "strike": option_part(s, 3).try_cast("double"), "type": option_part(s, 4)})
    return out.where(F.col("underlying").isNotNull() & F.col("expiry").isNotNull())


def nearest_expiries(df: DataFrame, n: int, as_of: Column) -> DataFrame:
    """Rows of the first ``n`` expiries from ``as_of`` on of each underlying; ranks are taken over distinct expiries, a small table."""
    dates = df.where(F.col("expiry") >= as_of).select("underlying", "expiry").distinct()
    near = dates.withColumn("_r", F.row_number().over(Window.partitionBy("underlying").orderBy("expiry"))).where(F.col("_r") <= n).drop("_r")
    return df.join(near, ["underlying", "expiry"], "left_semi")


def snapshot(marks: DataFrame, tickers: DataFrame, spots: DataFrame, ticker_order: str, n_expiries: int, as_of: Column, delta: tuple[float, float] | None = None) -> DataFrame:
    """Marks with their ticker (the last per symbol; none is null) and the spot of the underlying, columns prefixed by origin."""
    from bartide.operators.clean import keep_last

    near = nearest_expiries(parsed(marks), n_expiries, as_of)
    if delta is not None:
        near = near.where(F.abs("delta").between(*delta))
    fixed = {"symbol", "underlying", "expiry", "strike", "type"}
    near = near.withColumnsRenamed({c: f"mark_{c}" for c in near.columns if c not in fixed})
    last = keep_last(tickers, ["symbol"], ticker_order)
    last = last.withColumnsRenamed({c: f"ticker_{c}" for c in last.columns if c != "symbol"})
    return near.join(last, "symbol", "left").join(spots.select("underlying", "spot"), "underlying", "left")
