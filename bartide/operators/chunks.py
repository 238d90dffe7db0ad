"""Cutting long per-source sequences into bounded, overlapping pieces.

A source may hold a third of all rows, at any density in time, so no operator here lets
one task see a whole source. Rows are range-partitioned by source and order; counts by
(source, partition), a small table, give each row its place in its source; chunks are
runs of places, and rows within a halo of a neighbouring chunk go to that chunk too.
Every row has one owner, and copies are bounded by the halo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bartide.session import cut


def epoch_us(column) -> F.Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column read as UTC."""
    c = F.col(column) if isinstance(column, str) else column
    whole = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return whole * F.lit(1_000_000).cast("long") + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def ranked(df: DataFrame, source: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with _part and _i, and the table of (source, _part, _base) of which ``_i + _base`` is a row's place in its
    source (from 0) by ``order``, which must tell all rows of a source apart. See ``placed``."""
    rows = df.repartitionByRange(source, *order).sortWithinPartitions(source, *order)
    rows = cut(rows.withColumns({"_part": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "ranked")
    parts = rows.groupBy(source, "_part").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(source).orderBy("_part")) - F.col("_n")
    return rows, parts.select(source, "_part", (before - F.col("_first")).alias("_base"))


def placed(rows: DataFrame, bases: DataFrame, source: str) -> DataFrame:
    """The rows of ``ranked`` with _pos, and with what else ``bases`` holds."""
    return rows.join(bases, [source, "_part"]).withColumn("_pos", F.col("_i") + F.col("_base")).drop("_part", "_i", "_base")


def chunked(rows: DataFrame, size: int, halo: int) -> DataFrame:
    """``rows`` (with _pos) with _chunk and _own; a row appears once for each chunk that needs it."""
    reach = F.sequence(F.expr(f"greatest(_pos - {halo}, 0L) div {size}"), F.expr(f"(_pos + {halo}) div {size}"))
    return rows.withColumn("_chunk", F.explode(reach)).withColumn("_own", F.expr(f"_pos div {size}") == F.col("_chunk"))
