"""Datasets by name and alias, with what readers and validators need to know of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    aliases: tuple[str, ...] = ()
    partition: str = "symbol"
    grain: str = "month"  # month, year or none (wide matrices)
    time: str = "time"
    zone: str = "UTC"
    step_s: int | None = None
    volume: str = "double"
    kind: str = "candle"  # candle, orderbook, option, matrix
    floor_s: int | None = None
    required: tuple[str, ...] = field(default=("time", "symbol", "open", "high", "low", "close", "volume"))
    normalise: Callable[[DataFrame], DataFrame] | None = None  # applied to rows as they are read, before casts


_VN = "Asia/Ho_Chi_Minh"
DATASETS = [
    Dataset("vn_stock_1m", "vn/stock_1m", ("vn_equity_1m",), zone=_VN, volume="bigint"),
    Dataset("vn_stock_daily", "vn/stock_1d", ("vn_equity_1d", "vn_stock_1d"), grain="year", zone=_VN, volume="bigint"),
    Dataset("vn_futures_1m", "vn/futures_1m", zone=_VN, volume="bigint"),
    Dataset("crypto_1m", "crypto/futures_1m", ("crypto_binance_futures_1m",), step_s=60),
    Dataset("crypto_binance_quarterly_1m", "crypto/quarterly_1m", ("binance_usdm_quarterly_1m",), step_s=60),
    Dataset("crypto_binance_spot_1m", "crypto/spot_1m", ("binance_spot_1m", "crypto_spot_1m"), step_s=60, floor_s=60),
    Dataset("crypto_daily_ohlcv", "crypto/daily", grain="year", step_s=86_400),
    Dataset("crypto_binance_orderbook_snapshot_1h", "crypto/orderbook_1h", ("binance_orderbook_snapshot_1h", "orderbook_snapshot_1h"), step_s=3600, kind="orderbook", required=("time", "symbol")),
    Dataset("options_5m", "crypto/options_5m", partition="underlying", time="snapshot_time", step_s=300, kind="option", required=("snapshot_time", "symbol")),
    Dataset("binance_daily_matrix", "matrix/crypto", grain="none", kind="matrix"),
    Dataset("vn_daily_matrix", "matrix/vn", grain="none", zone=_VN, volume="bigint", kind="matrix"),
]
_BY_NAME = {n: d for d in DATASETS for n in (d.name, *d.aliases)}


def register(ds: Dataset) -> Dataset:
    """Add a dataset, or put it in place of one of its names."""
    _BY_NAME.update({n.lower(): ds for n in (ds.name, *ds.aliases)})
    return ds


def dataset(name: str) -> Dataset:
    try:
        return _BY_NAME[name.lower()]
    except KeyError:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(sorted(_BY_NAME))}") from None
