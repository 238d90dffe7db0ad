"""Sets of symbols and parts of tables put together. Names are small tables; rows are not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered(lists: list[DataFrame]) -> DataFrame:
    """symbol, priority, position: each name (trimmed, in capitals) once, under the first of ``lists`` (column symbol) that has it.

    Names are first reduced to one row each; numbering them is for lists of names, not for tables that grow."""
    parts = [d.select(F.upper(F.trim("symbol")).alias("symbol"), F.lit(i).alias("priority")) for i, d in enumerate(lists, 1)]
    names = reduce(DataFrame.unionByName, parts).where("symbol is not null").groupBy("symbol").agg(F.min("priority").alias("priority"))
    return names.withColumn("position", F.row_number().over(Window.orderBy("priority", "symbol")))


def active(names: DataFrame, rows: DataFrame) -> DataFrame:
    """The names that ``rows`` have."""
    return names.join(rows.select("symbol").distinct(), "symbol", "left_semi")


def inactive(names: DataFrame, rows: DataFrame) -> DataFrame:
    return names.join(rows.select("symbol").distinct(), "symbol", "left_anti")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Symbols of both tables."""
    return a.where("symbol is not null").select("symbol").intersect(b.select("symbol"))


def united(*parts: DataFrame) -> DataFrame:
    """All rows of all parts by column name; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
