"""Loading datasets by name, symbols, time range and limit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide import validate
from bartide.operators import matrix
from bartide.operators.clean import PRICES, repair_bounds
from bartide.registry import Dataset, dataset
from bartide.sources import lake


def _bound(value) -> datetime | None:
    return None if value is None else value if isinstance(value, datetime) else datetime.fromisoformat(str(value))


class Reader:
    """Readers of one lake. All results are lazy."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def load(self, name: str, symbols=None, start=None, end=None, limit: int | None = None, feature: str | None = None) -> DataFrame:
        """Rows sorted by (symbol, time); ``limit`` is on the whole sorted result; a date-only ``end`` means its midnight."""
        ds = dataset(name)
        if ds.kind == "matrix":
            if feature is None:
                raise ValueError(f"{name} is a matrix: which feature?")
            return self.wide(ds, feature, symbols, start, end, limit)
        df = lake.scan(self.spark, self.root, ds, symbols, _bound(start), _bound(end))
        df = _normal(df, ds).orderBy("symbol", ds.time)
        return df.limit(limit) if limit is not None else df

    def long(self, ds: Dataset, feature: str, symbols=None, start=None, end=None) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/{ds.path}").select("symbol", "time", F.col(feature).cast(ds.volume if feature == "volume" else "double").alias(feature))
        names = lake.symbol_list(symbols)
        if names is not None:
            df = df.where(F.col("symbol").isin(names))
        for bound, test in ((_bound(start), F.col("time").__ge__), (_bound(end), F.col("time").__le__)):
            if bound is not None:
                df = df.where(test(F.lit(bound).cast("timestamp_ntz")))
        return df

    def wide(self, ds: Dataset, feature: str, symbols=None, start=None, end=None, limit: int | None = None) -> DataFrame:
        """Time by symbol, columns in the order asked for (all symbols: by name; they are folders, so listing them is cheap)."""
        names = lake.symbol_list(symbols) or [r.symbol for r in lake.discover(self.spark, self.root, ds).orderBy("symbol").collect()]
        out = matrix.pivot(self.long(ds, feature, names, start, end), names, feature).orderBy("time")
        return out.limit(limit) if limit is not None else out

    def features(self, name: str, features: list[str], **kwargs) -> dict[str, DataFrame]:
        return {f: self.load(name, feature=f, **kwargs) for f in features}

    def load_features(self, name: str, symbols=None, start=None, end=None, limit: int | None = None) -> DataFrame:
        """The stored features of a dataset that isn't a matrix (an order book's): another name of ``load``."""
        return self.load(name, symbols, start, end, limit)

    def ohlcv(self, name: str, symbols=None, start=None, end=None) -> DataFrame:
        """Long OHLCV of a matrix dataset, rows with any null left out; bounds repaired where the dataset asks for it."""
        ds = dataset(name)
        df = self.spark.read.parquet(f"{self.root}/{ds.path}")
        names = lake.symbol_list(symbols)
        df = df.where(F.col("symbol").isin(names)) if names is not None else df
        for bound, test in ((_bound(start), F.col("time").__ge__), (_bound(end), F.col("time").__le__)):
            df = df.where(test(F.lit(bound).cast("timestamp_ntz"))) if bound is not None else df
        df = df.select("time", "symbol", *matrix.FEATURES).dropna()
        return repair_bounds(df) if ds.name.startswith("vn_") else df

    def validate(self, df: DataFrame, name: str) -> dict:
        return validate.report(df, name)


def _normal(df: DataFrame, ds: Dataset) -> DataFrame:
    df = df.transform(ds.normalise) if ds.normalise else df
    if ds.kind != "candle":
        return df
    casts = {p: F.col(p).try_cast("double") for p in PRICES}
    casts["volume"] = F.coalesce(F.col("volume").try_cast("double"), F.lit(0.0)).try_cast(ds.volume)
    return df.withColumns(casts).where(F.col(ds.time).isNotNull())


def load_data(spark: SparkSession, root: str, name: str, symbols=None, start=None, end=None, limit: int | None = None, feature: str | None = None) -> DataFrame:
    return Reader(spark, root).load(name, symbols, start, end, limit, feature)
