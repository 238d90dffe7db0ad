"""Deduplicating new batches against all accepted history, with a persisted index.

Method: an inverted file of vector cells. A bar is the vector (time, open, high, low,
close, volume) of its instrument; two bars repeat one another if no coordinate is
further apart than its radius (10 seconds, 0.1 %, 1 %), coordinates that either side
lacks not counting. The coarse quantizer is a lattice: a cell is an instrument and a
minute, and stores full vectors. The distance from a query to a cell is bounded below
by the gap in time, so a query probes its own cell and a neighbour only where the bound
is within the radius: at most two cells, and no match is ever missed. Candidates are
reranked by the exact rule. Accepted bars are appended to their cells.

The index is Parquet, in folders by day and batch and sorted by cell inside; a batch
lists and reads only the days it touches, however many. It is a folder that any later
session opens again: what a batch adds lies in folders of the batch's name, which a
retry overwrites, and a batch that was begun but never finished isn't read.

Bars of one batch are resolved in arrival order: a bar is a repeat if an accepted bar
of history or an earlier bar of the batch that is no repeat itself matches it. Exact
copies are one node, so a hot bar costs one row; nodes that match no earlier one of the
batch are settled at once, and the others in rounds over the edges that are still open,
each round written to the shared folder.

Defined results: null or NaN coordinates aren't compared; a row with null time or
symbol (or none but separators) repeats nothing and nothing repeats it; spellings of a
symbol that differ in case, width, blanks or separators are one instrument; empty
batches give no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.operators.chunks import epoch_us
from bartide.session import cut, discard, work_path
from bartide.sources import files

NUMBERS = ("open", "high", "low", "close", "volume")
RADIUS = {"open": 0.001, "high": 0.001, "low": 0.001, "close": 0.001, "volume": 0.01}
RADIUS_US, CELL_US, DAY_US = 10_000_000, 60_000_000, 86_400_000_000
STORED = "id long, key string, us long, open double, high double, low double, close double, volume double, cell long, day int, batch string"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F))


def instrument(symbol: Column) -> Column:
    """One spelling per instrument; null if nothing is left."""
    key = F.regexp_replace(F.upper(F.translate(symbol, _WIDE, _PLAIN)), "[^A-Z0-9]", "")
    return F.when(key != "", key)


def vectors(df: DataFrame, id_column: str) -> DataFrame:
    """id, key, us, the numbers with NaN as null; rows that can be compared only."""
    number = lambda n: F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")).alias(n)
    out = df.select(F.col(id_column).alias("id"), instrument(F.col("symbol")).alias("key"), epoch_us("time").alias("us"), *[number(n) for n in NUMBERS])
    return out.where(F.col("key").isNotNull() & F.col("us").isNotNull())


def _cell(us: Column) -> Column:
    return F.floor(us / F.lit(CELL_US)).cast("long")


def _day(us: Column) -> Column:
    return F.floor(us / F.lit(DAY_US)).cast("int")


def _matches(a: str, b: str) -> Column:
    near = [F.abs(F.col(f"{a}.us") - F.col(f"{b}.us")) <= RADIUS_US]
    for n, r in RADIUS.items():
        x, y = F.col(f"{a}.{n}"), F.col(f"{b}.{n}")
        near.append(x.isNull() | y.isNull() | (F.abs(x - y) <= r * F.greatest(F.abs(x), F.abs(y))))
    return reduce(lambda p, q: p & q, near)


def _collapsed(v: DataFrame) -> DataFrame:
    """Exact copies as one row with the smallest id."""
    return v.groupBy("key", "us", *NUMBERS).agg(F.min("id").alias("id"))


def _probes(nodes: DataFrame) -> DataFrame:
    """Nodes with each cell whose lower distance bound is within the radius."""
    cells = F.sequence(_cell(F.col("us") - RADIUS_US), _cell(F.col("us") + RADIUS_US))
    probes = nodes.withColumn("cell", F.explode(cells))
    return probes.withColumn("day", F.floor(F.col("cell") * CELL_US / F.lit(DAY_US)).cast("int"))


class CellIndex:
    """The persisted cells below ``path``: day=.../batch=.../; opening an existing path finds what is there.

    One writer at a time, batches in order of arrival; the last one may be repeated under its name."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "cells")

    def _marker(self, batch: str) -> str:
        return f"{self.path}/_begun/{batch}"

    def append(self, v: DataFrame, batch: str) -> None:
        """Add accepted rows as those of ``batch``, in place of what an earlier attempt at it added."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a name of a batch: {batch!r}")
        rows = v.withColumns({"cell": _cell(F.col("us")), "day": _day(F.col("us")), "batch": F.lit(batch)})
        rows = rows.repartitionByRange("day", "key", "cell").sortWithinPartitions("day", "key", "cell")
        files.touch(self.spark, self._marker(batch))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(self.path)
        files.delete(self.spark, self._marker(batch))

    def candidates(self, probes: DataFrame, batch: str = "") -> DataFrame | None:
        """Rows of the days that ``probes`` touch, of finished batches other than ``batch``; None if there are none."""
        days = [int(n[4:]) for n in files.names(self.spark, self.path) if n.startswith("day=")]
        if not days:
            return None
        held = self.spark.createDataFrame(pd.DataFrame({"day": days}), "day int")
        touched = [r.day for r in probes.select("day").distinct().join(held, "day", "left_semi").collect()]  # at most the folders there are
        if not touched:
            return None
        stored = self.spark.read.schema(STORED).option("basePath", self.path).parquet(*[f"{self.path}/day={d}" for d in sorted(touched)])
        return stored.where(~F.col("batch").isin(batch, *files.names(self.spark, f"{self.path}/_begun")))

    def nearest(self, nodes: DataFrame, batch: str = "") -> DataFrame:
        """id, kept: the smallest stored id that each node repeats."""
        probes = _probes(nodes)
        stored = self.candidates(probes, batch)
        if stored is None:
            return nodes.select("id", F.col("id").alias("kept")).where(F.lit(False))
        p, s = probes.alias("p"), stored.alias("s")
        same_cell = (F.col("p.day") == F.col("s.day")) & (F.col("p.key") == F.col("s.key")) & (F.col("p.cell") == F.col("s.cell"))
        return p.join(s, same_cell & _matches("p", "s")).groupBy("p.id").agg(F.min("s.id").alias("kept"))


def _edges(nodes: DataFrame) -> DataFrame:
    """(i, j): node i matches the earlier node j."""
    p, s = _probes(nodes).alias("p"), nodes.withColumn("cell", _cell(F.col("us"))).alias("s")
    same_cell = (F.col("p.key") == F.col("s.key")) & (F.col("p.cell") == F.col("s.cell")) & (F.col("s.id") < F.col("p.id"))
    return p.join(s, same_cell & _matches("p", "s")).select(F.col("p.id").alias("i"), F.col("s.id").alias("j"))


def _resolve(first: DataFrame, edges: DataFrame) -> DataFrame:
    """``first`` (id, state: 1 accepted, 2 repeat, 0 open) settled in arrival order: id, state.

    Each round settles every open node that matches an accepted one, or all of whose earlier matches are repeats. It reads
    the edges that are still open and the nodes settled in the round before only."""
    done = fresh = first.where("state > 0").select("id", "state")
    left = edges.join(first.where("state = 0").select(F.col("id").alias("i")), "i", "left_semi")
    while True:
        step = left.join(fresh.select(F.col("id").alias("j"), "state"), "j", "left")
        # An edge to a repeat counts no more; one to an accepted node settles its node; the others stay open.
        node = step.groupBy("i").agg(F.max((F.col("state") == 1).cast("int")).alias("_acc"), F.count_if(F.col("state").isNull()).alias("_open"))
        fresh = cut(node.select(F.col("i").alias("id"), F.when(F.col("_acc") == 1, 2).when(F.col("_open") == 0, 1).otherwise(0).alias("state")), "round")
        if fresh.isEmpty():
            return done
        still = fresh.where("state = 0").select(F.col("id").alias("i"))
        before, left = left, cut(step.where("state is null").select("i", "j").join(still, "i", "left_semi"), "open")
        if hasattr(before, "_cut_path"):
            discard(before)
        fresh = fresh.where("state > 0")
        done = done.unionByName(fresh)


def dedup(index: CellIndex, rows: DataFrame, id_column: str = "in_id", batch: str | None = None) -> DataFrame:
    """Repeats of ``rows`` (kept_id, id_column); what is accepted is appended to ``index`` under the name ``batch``.

    Doing a batch again under its name gives the same rows and leaves the same index. Without a name it is a new batch."""
    batch = batch or uuid.uuid4().hex
    rows = cut(vectors(rows, id_column), "batch")
    nodes = cut(_collapsed(rows), "nodes")
    edges = cut(_edges(nodes), "edges")
    depends = edges.select(F.col("i").alias("id")).distinct().withColumn("_d", F.lit(True))
    state = F.when(F.col("kept").isNotNull(), 2).when(F.col("_d").isNull(), 1).otherwise(0)
    first = cut(nodes.join(index.nearest(nodes, batch), "id", "left").join(depends, "id", "left").withColumn("state", state).drop("_d"), "nearest")
    settled = _resolve(first, edges)
    accepted = settled.where("state = 1").select("id")
    inside = edges.join(accepted.withColumnRenamed("id", "j"), "j").groupBy(F.col("i").alias("id")).agg(F.min("j").alias("_in"))
    node_kept = first.drop("state").join(settled, "id").join(inside, "id", "left").withColumn("_kept", F.when(F.col("state") == 2, F.least("kept", "_in")))
    # Copies of a node that was accepted repeat it; copies of a repeat repeat what it does.
    same = reduce(lambda p, q: p & q, [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("key", "us", *NUMBERS)])
    placed = rows.alias("r").join(node_kept.alias("n"), same).select(F.col("r.id").alias("id"), F.col("n.id").alias("node"), F.col("n._kept").alias("kept"))
    kept = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("id") != F.col("node"), F.col("node"))
    found = cut(placed.withColumn("kept", kept).where(F.col("kept").isNotNull()).select(F.col("kept").alias("kept_id"), F.col("id").alias(id_column)), "repeats")
    index.append(nodes.join(accepted, "id").select("id", "key", "us", *NUMBERS), batch)
    return found


def build(history: DataFrame, id_column: str = "bar_id", path: str | None = None, batch: str = "history") -> CellIndex:
    index = CellIndex(history.sparkSession, path)
    index.append(_collapsed(vectors(history, id_column)).select("id", "key", "us", *NUMBERS), batch)
    return index
