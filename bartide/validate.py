"""Data-quality reports: one aggregation pass over the rows, plus continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bartide.functions.market import no_nan
from bartide.operators import gaps
from bartide.registry import Dataset, dataset

NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)


def rule_counts(df: DataFrame) -> DataFrame:
    """One row: violations of each OHLCV rule, nulls, duplicates, range of time."""
    o, h, lo, c, v = (no_nan(F.col(k).cast("double")) for k in ("open", "high", "low", "close", "volume"))

    def n(test: Column, name: str) -> Column:
        return F.count_if(test).alias(name)

    nulls = sum(((x.isNull()).cast("long") for x in (o, h, lo, c, v)), F.col("time").isNull().cast("long") + F.col("symbol").isNull().cast("long"))
    keyed = df.groupBy("symbol", "time").agg(  # duplicates need the key; the rest is combined before that shuffle
        F.count("*").alias("_n"), n(o < 0, "neg_open"), n(h < 0, "neg_high"), n(lo < 0, "neg_low"), n(c < 0, "neg_close"), n(h < lo, "high_below_low"), n(h < o, "high_below_open"),
        n(h < c, "high_below_close"), n(lo > o, "low_above_open"), n(lo > c, "low_above_close"), n(v < 0, "neg_volume"), F.sum(nulls).alias("nulls"),
    )
    sums = ["neg_open", "neg_high", "neg_low", "neg_close", "high_below_low", "high_below_open", "high_below_close", "low_above_open", "low_above_close", "neg_volume", "nulls"]
    return keyed.agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("row_count"), *[F.coalesce(F.sum(s), F.lit(0).cast("long")).alias(s) for s in sums],
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0).cast("long")).alias("duplicates"), F.count_distinct("symbol").alias("symbols"), F.min("time").alias("min_time"), F.max("time").alias("max_time"),
    )


def unsorted_symbols(df: DataFrame, order: str) -> DataFrame:
    """Symbols with a reading that arrived (by ``order``) after one of a later time: symbol, n_late.

    Compared with the running maximum inside blocks of arrival, and with the maximum of the blocks before."""
    from pyspark.sql import Window

    df = df.where(F.col("symbol").isNotNull() & F.col("time").isNotNull()).withColumn("_b", F.expr(f"{order} div 100000"))
    inside = F.max("time").over(Window.partitionBy("symbol", "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    blocks = df.groupBy("symbol", "_b").agg(F.max("time").alias("_m"))
    blocks = blocks.withColumn("_before", F.max("_m").over(Window.partitionBy("symbol").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_m")
    late = df.withColumn("_in", inside).join(blocks, ["symbol", "_b"]).where(F.greatest("_in", "_before") > F.col("time"))
    return late.groupBy("symbol").agg(F.count("*").alias("n_late"))


def _types(df: DataFrame, required: tuple[str, ...], numeric: tuple[str, ...]) -> list[str]:
    missing = [c for c in required if c not in df.columns]
    if missing:
        return [f"missing columns: {missing}"]
    return [f"column {c!r} is not numeric" for c in numeric if c in df.columns and not isinstance(df.schema[c].dataType, NUMERIC)]


def report(df: DataFrame, name: str | Dataset, **expected) -> dict:
    """{valid, row_count, errors, info}. Type errors come first and end the report; an empty frame is invalid.

    ``expected``: start, end and symbols of ``gaps.ranges``, by which gaps at the ends count too."""
    ds = name if isinstance(name, Dataset) else dataset(name)
    out: dict = {"valid": False, "row_count": 0, "errors": [], "info": {}}
    if ds.kind == "matrix":
        return _matrix(df, out)
    numeric = ("open", "high", "low", "close", "volume") if ds.kind == "candle" else tuple(c for c in df.columns if "depth" in c or "notional" in c)
    out["errors"] = _types(df, ds.required, numeric)
    if out["errors"]:
        return out
    if ds.kind == "candle":
        r = rule_counts(df).first().asDict()
        texts = {
            "neg_open": "negative open", "neg_high": "negative high", "neg_low": "negative low", "neg_close": "negative close", "high_below_low": "high < low",
            "high_below_open": "high < open", "high_below_close": "high < close", "low_above_open": "low > open", "low_above_close": "low > close",
            "neg_volume": "negative volume", "nulls": "nulls in required columns", "duplicates": "duplicate (symbol, time)",
        }
    else:
        negatives = [F.count_if(F.col(c) < 0).alias(c) for c in numeric]
        keyed = df.groupBy("symbol", ds.time).agg(F.count("*").alias("_n"), *negatives)
        r = keyed.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"), *[F.sum(c).alias(c) for c in numeric]).first().asDict()
        texts = {"duplicates": "duplicate (symbol, time)", **{c: f"negative {c}" for c in numeric}}
    out["row_count"] = r["row_count"]
    if not r["row_count"]:
        out["errors"].append("no rows")
        return out
    out["info"] = {k: v for k, v in r.items() if k != "row_count"}
    out["errors"] = [f"{text}: {r[k]}" for k, text in texts.items() if r[k]]
    if ds.step_s and ds.kind != "option":
        found = gaps.ranges(df, ds.step_s, floor_s=None, time=ds.time, **expected)
        total = found.agg(F.count("*").alias("n"), F.max("seconds").alias("m"), F.count_distinct("symbol").alias("s")).first()
        out["info"] |= {"gaps": total.n, "max_gap_s": total.m}
        if total.n:
            some = example_gaps(found).collect()
            out["info"]["examples"] = [{k: str(r[k]) if r[k] is not None else None for k in ("symbol", "prev", "next", "missing")} for r in some]
            out["errors"].append(f"gaps: {total.n} in {total.s} symbols, first {some[0].symbol} from {some[0].missing_start}")
    out["valid"] = not out["errors"]
    return out


def example_gaps(found: DataFrame, n: int = 5) -> DataFrame:
    """The first gap of each symbol, of the ``n`` symbols that come first."""
    first = found.groupBy("symbol").agg(F.min_by(F.struct(*[c for c in found.columns if c != "symbol"]), "missing_start").alias("_g"))
    return first.orderBy("symbol").limit(n).select("symbol", "_g.*")


def audit(df: DataFrame, step_s: int, expected_start=None, since=None) -> DataFrame:
    """Per symbol: rows, n_times, min_time, max_time, duplicates, n_gaps, max_gap_minutes, gap_minutes (with the head gap from
    ``expected_start``); where there are prices also ohlc_bad and negative rows. ``since``: rows before it don't count."""
    df = df.where(F.col("time").isNotNull() & F.col("symbol").isNotNull())
    df = df if since is None else df.where(F.col("time") >= F.lit(since).cast("timestamp_ntz"))
    keyed = [F.count("*").alias("_n")]
    if "open" in df.columns:
        o, h, lo, c, v = (no_nan(F.col(k).cast("double")) for k in ("open", "high", "low", "close", "volume"))
        keyed += [F.count_if((h < F.greatest(o, c, lo)) | (lo > F.least(o, c, h))).alias("ohlc_bad"), F.count_if((F.least(o, h, lo, c) < 0) | (v < 0)).alias("negative")]
    per = df.groupBy("symbol", "time").agg(*keyed)
    sums = per.groupBy("symbol").agg(
        F.sum("_n").alias("rows"), F.count("*").alias("n_times"), F.min("time").alias("min_time"), F.max("time").alias("max_time"), F.sum(F.col("_n") - 1).alias("duplicates"),
        *[F.sum(c).alias(c) for c in ("ohlc_bad", "negative") if c in per.columns],
    )
    if expected_start is None:
        found = gaps.steps(df, floor_s=None).where(F.col("seconds") > step_s).select("symbol", F.expr("seconds div 60 - 1").alias("gap_minutes"))
    else:
        found = gaps.with_head(df, step_s, expected_start, floor_s=None)
    found = found.groupBy("symbol").agg(F.count("*").alias("n_gaps"), F.max("gap_minutes").alias("max_gap_minutes"), F.sum("gap_minutes").alias("gap_minutes"))
    zero = F.lit(0).cast("long")
    return sums.join(found, "symbol", "left").withColumns({c: F.coalesce(c, zero) for c in ("n_gaps", "max_gap_minutes", "gap_minutes")})


def _matrix(df: DataFrame, out: dict) -> dict:
    first, rest = df.columns[0], df.columns[1:]
    if not isinstance(df.schema[first].dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        out["errors"].append("the first column is not a date")
    out["errors"] += [f"column {c!r} is not numeric" for c in rest if not isinstance(df.schema[c].dataType, NUMERIC)]
    if out["errors"]:
        return out
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in rest), F.lit(0))
    r = df.agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"), F.min(first).alias("a"), F.max(first).alias("b")).first()
    out |= {"row_count": r.n, "info": {"nulls": r.nulls or 0, "shape": (r.n, len(rest)), "min_time": r.a, "max_time": r.b}}
    if not r.n:
        out["errors"].append("no rows")
    out["valid"] = not out["errors"]
    return out
