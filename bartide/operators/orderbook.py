"""Order-book features: bands around the mid from percentage rows or from price levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bartide.functions.market import band_token, imbalance, mid, spread_bps
from bartide.operators.clean import latest_per_bucket


def bands_from_percentages(df: DataFrame, bands: list[float], primary: float, keys: list[str], order: str) -> DataFrame:
    """Rows (keys, percentage, depth, notional; negative percentages are bids) as one row per key with columns per band.

    Percentages are matched to 8 decimals; of rows with one percentage the last by ``order`` counts."""
    pct = F.round("percentage", 8)

    def at(value: str, percent: float) -> Column:
        hit = pct == F.lit(round(percent, 8))
        return F.max_by(F.when(hit, F.col(value)), F.when(hit, F.col(order)))

    aggs = []
    for b in bands:
        for side, sign in (("bid", -1), ("ask", 1)):
            for value in ("depth", "notional"):
                aggs.append(at(value, sign * b * 100).alias(f"{side}_{value}_{band_token(b)}"))
    wide = df.groupBy(*keys).agg(*aggs)
    return _with_imbalance(wide, bands, primary)


def _with_imbalance(wide: DataFrame, bands: list[float], primary: float) -> DataFrame:
    for b in bands:
        t = band_token(b)
        wide = wide.withColumn(f"imbalance_{t}", imbalance(F.col(f"bid_depth_{t}"), F.col(f"ask_depth_{t}")))
    t = band_token(primary)
    return wide.withColumns({
        "primary_bid_depth": F.col(f"bid_depth_{t}"), "primary_ask_depth": F.col(f"ask_depth_{t}"),
        "primary_bid_notional": F.col(f"bid_notional_{t}"), "primary_ask_notional": F.col(f"ask_notional_{t}"), "primary_imbalance": F.col(f"imbalance_{t}"),
    })


def hourly(df: DataFrame, bands: list[float], primary: float, order: str) -> DataFrame:
    """The last snapshot of each symbol and hour (symbol, time, sample_time, percentage, depth, notional) as features."""
    last = latest_per_bucket(df, ["symbol", "time"], "sample_time")
    return bands_from_percentages(last, bands, primary, ["symbol", "time", "sample_time"], order)


def bands_from_levels(df: DataFrame, bands: list[float], primary: float, bids: str = "bids", asks: str = "asks") -> DataFrame:
    """Levels (arrays of struct<price, qty>, best first) as mid, spread and the depth and notional within each band. No explode: array functions."""
    bid, ask = F.try_element_at(bids, F.lit(1))["price"], F.try_element_at(asks, F.lit(1))["price"]
    df = df.withColumns({"best_bid": bid, "best_ask": ask})
    df = df.withColumns({"mid_price": mid(F.col("best_bid"), F.col("best_ask")), "spread_bps": spread_bps(F.col("best_bid"), F.col("best_ask"))})
    zero = F.lit(0.0)
    for b in bands:
        t = band_token(b)
        low, high = F.col("mid_price") * (1 - b), F.col("mid_price") * (1 + b)
        near = {"bid": F.filter(bids, lambda x: x["price"] >= low), "ask": F.filter(asks, lambda x: x["price"] <= high)}
        for side, levels in near.items():
            df = df.withColumns({
                f"{side}_depth_{t}": F.aggregate(levels, zero, lambda a, x: a + x["qty"]),
                f"{side}_notional_{t}": F.aggregate(levels, zero, lambda a, x: a + x["qty"] * x["price"]),
            })
    return _with_imbalance(df, bands, primary)


def schema_columns(bands: list[float]) -> list[str]:
    """The feature columns that a list of bands leads to."""
    per = [f"{side}_{v}_{band_token(b)}" for b in bands for side in ("bid", "ask") for v in ("depth", "notional")]
    return per + [f"imbalance_{band_token(b)}" for b in bands]
