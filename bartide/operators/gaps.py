"""Continuity: gaps between readings, missing periods, and where to resume.

Neighbours are found inside (source, day) pieces; pieces are stitched on a table of one
row per source and day, so a long source is many tasks and results are those of one
window over all its readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bartide.functions.market import add_seconds, floor_time, seconds_between


def steps(df: DataFrame, symbol: str = "symbol", time: str = "time", floor_s: int | None = 60) -> DataFrame:
    """symbol, prev, next, seconds: every pair of neighbouring distinct times."""
    t = floor_time(F.col(time), floor_s) if floor_s else F.col(time)
    times = df.where(F.col(time).isNotNull() & F.col(symbol).isNotNull()).select(F.col(symbol).alias("symbol"), t.alias("t")).distinct().withColumn("_d", F.col("t").cast("date"))
    inner = times.withColumn("prev", F.lag("t").over(Window.partitionBy("symbol", "_d").orderBy("t"))).where(F.col("prev").isNotNull()).select("symbol", "prev", F.col("t").alias("next"))
    days = times.groupBy("symbol", "_d").agg(F.min("t").alias("next"), F.max("t").alias("_last"))
    across = days.withColumn("prev", F.lag("_last").over(Window.partitionBy("symbol").orderBy("_d"))).where(F.col("prev").isNotNull()).select("symbol", "prev", "next")
    return inner.unionByName(across).withColumn("seconds", seconds_between("prev", "next"))


def ranges(df: DataFrame, step_s: int, most_s: int | None = None, start=None, end=None, symbols: DataFrame | None = None, **names) -> DataFrame:
    """Gaps above ``step_s`` (and up to ``most_s``): prev, next, missing_start, missing_end, missing.

    ``start`` and ``end`` are the first and last period expected: the periods before the first reading and after the last one are
    gaps too, without prev or next. With both, each of ``symbols`` (column symbol) without readings is one gap."""
    g = steps(df, **names).where(F.col("seconds") > step_s)
    inner = g.select("symbol", "prev", "next", add_seconds(F.col("prev"), step_s).alias("missing_start"), add_seconds(F.col("next"), -step_s).alias("missing_end"),
                     F.expr(f"(seconds + {step_s - 1}) div {step_s} - 1").alias("missing"), "seconds")
    if start is not None or end is not None:
        inner = inner.unionByName(_ends(df, step_s, start, end, symbols, **names))
    return inner if most_s is None else inner.where(F.col("seconds") <= most_s)


def _ends(df: DataFrame, step_s: int, start, end, symbols: DataFrame | None, symbol: str = "symbol", time: str = "time", floor_s: int | None = 60) -> DataFrame:
    """The gaps at the ends, in the columns of ``ranges``; seconds as if a reading stood on either side."""
    t = floor_time(F.col(time), floor_s) if floor_s else F.col(time)
    ends = df.where(F.col(time).isNotNull() & F.col(symbol).isNotNull()).groupBy(F.col(symbol).alias("symbol")).agg(F.min(t).alias("_first"), F.max(t).alias("_last"))
    if symbols is not None:
        ends = ends.join(symbols.where("symbol is not null").select("symbol").distinct(), "symbol", "full")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    none, a, b = at(None), at(start), at(end)
    part = lambda prev, following, x, y: F.struct(prev.alias("prev"), following.alias("next"), x.alias("missing_start"), y.alias("missing_end"))
    first, last = F.col("_first"), F.col("_last")
    parts = F.array(
        F.when(first.isNotNull(), part(none, first, a, F.least(add_seconds(first, -step_s), b))),
        F.when(first.isNotNull(), part(last, none, F.greatest(add_seconds(last, step_s), a), b)),
        F.when(first.isNull(), part(none, none, a, b)),
    )
    found = ends.select("symbol", F.explode(parts).alias("_p")).select("symbol", "_p.*").where("missing_start <= missing_end")
    n = seconds_between("missing_start", "missing_end")
    return found.withColumn("missing", F.expr(f"timestampdiff(SECOND, missing_start, missing_end) div {step_s} + 1")).withColumn("seconds", n + 2 * step_s)


def scan(df: DataFrame, step_s: int, **names) -> DataFrame:
    """Per source: number of gaps and the longest, also for sources without any."""
    return steps(df, **names).groupBy("symbol").agg(F.count_if(F.col("seconds") > step_s).alias("n_gaps"), F.max(F.when(F.col("seconds") > step_s, F.col("seconds"))).alias("max_gap_s"))


def missing_times(gaps: DataFrame, step_s: int) -> DataFrame:
    """One row per missing period of ``gaps`` (symbol, missing_start, missing_end)."""
    n = seconds_between("missing_start", "missing_end")
    return gaps.select("symbol", "missing_start", F.explode(F.sequence(F.lit(0), (n / step_s).cast("int"))).alias("_i")).select("symbol", add_seconds(F.col("missing_start"), F.col("_i") * step_s).alias("time"))


def resume(df: DataFrame, symbols: DataFrame, backfill_start, step_s: int, overlap_s: int, **names) -> DataFrame:
    """Where to fetch on from: the backfill start for unknown sources or a late head, a first inner gap less the overlap, else the
    latest time less the overlap; never before the backfill start. ``symbols``: column symbol."""
    s = steps(df, floor_s=None, **names)
    name, time = names.get("symbol", "symbol"), names.get("time", "time")
    ends = df.where(F.col(time).isNotNull()).groupBy(F.col(name).alias("symbol")).agg(F.min(time).alias("_first"), F.max(time).alias("_latest"))
    first_gap = s.where(F.col("seconds") > step_s).groupBy("symbol").agg(F.min("prev").alias("_gap"))
    back = F.lit(backfill_start).cast("timestamp_ntz")
    joined = symbols.select("symbol").distinct().join(ends, "symbol", "left").join(first_gap, "symbol", "left")
    start = F.when(F.col("_first").isNull() | (F.col("_first") > add_seconds(back, step_s)), back).otherwise(add_seconds(F.coalesce("_gap", "_latest"), -overlap_s))
    return joined.select("symbol", F.greatest(start, back).alias("fetch_from"), "_first", "_latest").withColumnsRenamed({"_first": "first_time", "_latest": "latest_time"})


def resume_latest(symbols: DataFrame, latest: list[DataFrame], backfill_start, overlap_s: int) -> DataFrame:
    """symbol, latest_time, fetch_from: the latest time that any source knows (``latest``: symbol, latest_time; a manifest, the
    storage, older files) less the overlap, the backfill start where none does."""
    known = latest[0].select("symbol", "latest_time")
    for other in latest[1:]:
        known = known.unionByName(other.select("symbol", "latest_time"))
    found = symbols.select("symbol").distinct().join(known.groupBy("symbol").agg(F.max("latest_time").alias("latest_time")), "symbol", "left")
    return found.withColumn("fetch_from", F.coalesce(add_seconds(F.col("latest_time"), -overlap_s), F.lit(backfill_start).cast("timestamp_ntz")))


def with_head(df: DataFrame, step_s: int, expected, **names) -> DataFrame:
    """Gaps with a head gap where a source's first reading is later than ``expected``: symbol, prev, next, gap_minutes."""
    inner = steps(df, **names).where(F.col("seconds") > step_s).select("symbol", "prev", "next", F.expr("seconds div 60 - 1").alias("gap_minutes"))
    name, time = names.get("symbol", "symbol"), names.get("time", "time")
    start = F.lit(expected).cast("timestamp_ntz")
    firsts = df.where(F.col(time).isNotNull()).groupBy(F.col(name).alias("symbol")).agg(F.min(time).alias("next")).where(F.col("next") > start)
    minutes = F.expr("timestampdiff(SECOND, prev, next) div 60")
    return firsts.select("symbol", F.lit(expected).cast("timestamp_ntz").alias("prev"), "next").withColumn("gap_minutes", minutes).unionByName(inner)


def ratio_scale(a: DataFrame, b: DataFrame, value: str = "volume", highest: float = 1000.0) -> DataFrame:
    """symbol, n, ratio: the median of a's value over b's at equal times, of ratios in (0, highest); 1 where there is none."""
    both = a.select("symbol", "time", F.col(value).alias("_a")).join(b.select("symbol", "time", F.col(value).alias("_b")), ["symbol", "time"])
    ratio = F.try_divide("_a", "_b")
    return both.groupBy("symbol").agg(F.count("*").alias("n"), F.coalesce(F.median(F.when((ratio > 0) & (ratio < highest), ratio)), F.lit(1.0)).alias("ratio"))


def proxy_fill(spot: DataFrame, other: DataFrame, step_s: int, most_missing: int, context_s: int, scaled: list[str], copied: list[str], tag: str = "proxy_fill", **expected) -> DataFrame:
    """Rows for the gaps of ``spot`` that ``other`` covers completely: ``copied`` as they are, ``scaled`` times the median ratio of
    both within ``context_s`` around the gap (ratios in (0, 1000); 1 where there is none).

    Both have symbol and time, one row per symbol and time. ``expected``: start, end and symbols of ``ranges``. Gaps meet rows by hour, an equi-join, not by an open range."""
    g = ranges(spot, step_s, floor_s=None, **expected).where(F.col("missing") <= most_missing).withColumn("_g", F.struct("symbol", "missing_start"))
    g = g.select("_g", "symbol", "missing_start", "missing_end", "missing")
    hour = lambda c: F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01', {c}) div 3600")
    inside = g.withColumn("_h", F.explode(F.sequence(hour("missing_start"), hour("missing_end"))))
    rows = other.withColumn("_h", hour("time")).join(inside, ["symbol", "_h"]).where(F.col("time").between(F.col("missing_start"), F.col("missing_end")))
    on_grid = seconds_between("missing_start", "time") % step_s == 0
    covered = rows.groupBy("_g").agg(F.count("*").alias("_n"), F.count_if(on_grid).alias("_ok"), F.first("missing").alias("missing"))
    full = covered.where((F.col("_n") == F.col("missing")) & (F.col("_ok") == F.col("missing"))).select("_g")
    around = g.join(full, "_g", "left_semi").withColumns({"_a": add_seconds(F.col("missing_start"), -context_s), "_b": add_seconds(F.col("missing_end"), context_s)})
    around = around.withColumn("_h", F.explode(F.sequence(hour("_a"), hour("_b")))).select("_g", "symbol", "_h", "_a", "_b")
    pairs = spot.select("symbol", "time", *scaled).join(other.select("symbol", "time", *[F.col(c).alias(f"_o_{c}") for c in scaled]), ["symbol", "time"]).withColumn("_h", hour("time"))
    pairs = pairs.join(around, ["symbol", "_h"]).where(F.col("time").between(F.col("_a"), F.col("_b")))
    ratio = lambda c: F.try_divide(F.col(c), F.col(f"_o_{c}"))
    scales = pairs.groupBy("_g").agg(*[F.median(F.when((ratio(c) > 0) & (ratio(c) < 1000), ratio(c))).alias(f"_s_{c}") for c in scaled])
    filled = rows.join(full, "_g", "left_semi").join(scales, "_g", "left")
    return filled.select("symbol", "time", *copied, *[(F.col(c) * F.coalesce(f"_s_{c}", F.lit(1.0))).alias(c) for c in scaled], F.lit(tag).alias("source"))
