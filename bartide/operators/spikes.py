"""Implausible measurements: spikes, stuck values and impossible readings.

Method: a hidden Markov model per source and field with the states normal, spike,
stuck and out of range. Emissions are relative to the source's own behaviour (its
usual bar-to-bar move, its usual volume, how often it repeats a value); hard bounds
emit out of range with certainty. Forward-backward probabilities above one half
assign the flag.

Sequences are cut into overlapping chunks (``chunks.chunked``), so a source with a
third of all rows is many tasks; a source's parameters come from mergeable
percentile sketches and from counts of runs over all its readings, so they don't depend
on the chunks. The forward and backward passes are associative scans of 4 x 4
matrices, in numpy.

Defined results: null and NaN are never flagged and break no run; rows without time
or source can only be out of range; repeated deliveries of a reading count once in
the sequence and are all flagged; ties in time with different values are ordered by
their values; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bartide.operators.chunks import chunked, placed, ranked

FIELDS = ("close", "high", "volume")
NORMAL, SPIKE, STUCK, OUT = range(4)
#: Parameters by field: scale of a normal residual and range of a spike's (in units of
#: the source's usual move; for volume, natural logarithms).
SCALE = {"close": (1.8, 100.0), "high": (1.3, 100.0), "volume": (0.42, 25.0)}
#: Chance of entering each state, of leaving stuck, and the least chance that a
#: normal reading repeats the one before.
ENTER = {SPIKE: 1e-3, STUCK: 2e-3, OUT: 1e-3}
LEAVE_STUCK, LEAST_REPEAT, RUN_BLOCK = 0.05, 0.25, 4096
KEYS = ["symbol", "time", "open", "high", "low", "close", "volume"]


def _good(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def usual_behaviour(df: DataFrame) -> DataFrame:
    """By symbol: usual move within a bar (s) and usual log volume (g), from mergeable sketches."""
    o, c, v = F.col("open"), F.col("close"), F.col("volume")
    move = F.when(_good(o) & _good(c) & (o > 0) & (c > 0), F.abs(F.ln(c / o)))
    volume = F.when(_good(v) & (v > 0), F.ln(v))
    stats = df.groupBy("symbol").agg(F.percentile_approx(move, [0.5, 0.75], 1000).alias("m"), F.percentile_approx(volume, 0.5, 1000).alias("g"))
    s = F.greatest(F.get("m", F.lit(0)), F.get("m", F.lit(1)) / 1.7, F.lit(1e-6))
    return stats.select("symbol", F.coalesce(s, F.lit(1e-3)).alias("_s"), F.col("g").alias("_g"))


def usual_repeats(rows: DataFrame) -> DataFrame:
    """By symbol and field: the chance that a reading repeats the one before it (_p_close, ...), as the share of runs of two or
    more among its runs, so that one long run counts once. ``rows``: with _pos; runs end at every RUN_BLOCK-th reading."""
    block = Window.partitionBy("symbol", F.expr(f"_pos div {RUN_BLOCK}")).orderBy("_pos")
    earlier = block.rowsBetween(Window.unboundedPreceding, -1)
    value = {f: F.when(_good(F.col(f)) & (F.col(f) > 0), F.col(f)) for f in FIELDS}
    rows = rows.select("symbol", "_pos", *[v.alias(f) for f, v in value.items()])
    same = {f"_same_{f}": F.when(F.col(f).isNotNull(), F.coalesce(F.col(f) == F.last(f, True).over(earlier), F.lit(False))) for f in FIELDS}
    rows = rows.withColumns(same)
    rows = rows.withColumns({f"_then_{f}": F.coalesce(F.last(f"_same_{f}", True).over(earlier), F.lit(False)) for f in FIELDS})
    runs = [F.count_if(~F.col(f"_same_{f}")).alias(f"_runs_{f}") for f in FIELDS]
    longer = [F.count_if(F.col(f"_same_{f}") & ~F.col(f"_then_{f}")).alias(f"_longer_{f}") for f in FIELDS]
    rate = lambda f: F.least(F.greatest((F.col(f"_longer_{f}") + 1) / (F.col(f"_runs_{f}") + 4), F.lit(LEAST_REPEAT)), F.lit(0.9))
    return rows.groupBy("symbol").agg(*runs, *longer).select("symbol", *[rate(f).alias(f"_p_{f}") for f in FIELDS])


def _scan(m: np.ndarray) -> np.ndarray:
    """Running products m[0] @ ... @ m[i], each scaled to a largest entry of one."""
    m, step = m / m.max(axis=(-1, -2), keepdims=True), 1
    while step < len(m):
        p = m[:-step] @ m[step:]
        m = np.concatenate([m[:step], p / np.maximum(p.max(axis=(-1, -2), keepdims=True), 1e-300)])
        step *= 2
    return m


def posteriors(emit: np.ndarray) -> np.ndarray:
    """State probabilities for emissions of shape (readings, 4)."""
    a = np.full((4, 4), 0.0)
    for s in (NORMAL, SPIKE, OUT):
        for to, p in ENTER.items():
            a[s, to] = p
        a[s, NORMAL] = 1 - sum(ENTER.values())
    a[STUCK, STUCK], a[STUCK, NORMAL] = 1 - LEAVE_STUCK, LEAVE_STUCK - 2e-3
    a[STUCK, SPIKE] = a[STUCK, OUT] = 1e-3
    start = a[NORMAL]
    steps = a[None] * emit[:, None, :]
    forward = (start * emit[0])[None] if len(emit) == 1 else None
    if forward is None:
        run = _scan(steps[1:])
        forward = np.concatenate([(start * emit[0])[None], (start * emit[0]) @ run])
        # After the last reading the source is taken to behave normally again.
        tail = np.concatenate([steps[1:], (a * np.array([1.0, 0, 0, 0]))[None]])[::-1].transpose(0, 2, 1)
        backward = _scan(tail).transpose(0, 2, 1)[::-1] @ np.ones(4)
    else:
        backward = (a * np.array([1.0, 0, 0, 0])).sum(axis=1)[None]
    p = forward / forward.max(axis=1, keepdims=True) * (backward / np.maximum(backward.max(axis=1, keepdims=True), 1e-300))
    return p / p.sum(axis=1, keepdims=True)


def _emissions(residual: np.ndarray, same: np.ndarray, p_same: float, out: np.ndarray, known: np.ndarray, field: str) -> np.ndarray:
    scale, spread = SCALE[field]
    e = np.empty((len(residual), 4))
    e[:, NORMAL] = np.exp(-np.minimum(residual, 200 * scale) / scale) / scale * np.where(same, p_same, 1 - p_same)
    e[:, SPIKE] = np.where(same, 1e-3, 1.0) / spread
    e[:, STUCK] = np.where(same, 0.999, 1e-3) / scale
    e[:, OUT] = 1e-9 / spread
    e[out] = [0, 0, 0, 1]
    e[~known] = 1.0
    return np.maximum(e, 1e-200)


def _unchanged(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each known value equals the known one before it."""
    at = np.where(known, np.arange(len(x)), -1)
    before = np.maximum.accumulate(np.append(-1, at[:-1]))
    return known & (before >= 0) & (x == x[np.maximum(before, 0)])


def _next_good(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """For each reading, the first good value after it (NaN if none)."""
    at = np.where(good, np.arange(len(x)), len(x))
    after = np.append(np.minimum.accumulate(at[::-1])[::-1][1:], len(x))
    return np.append(x, np.nan)[after]


def flag_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Flags of the readings that the chunk owns."""
    pdf = pdf.sort_values("_pos", kind="stable").reset_index(drop=True)
    o, h, lo, c, v = (pdf[k].to_numpy("float64", na_value=np.nan) for k in KEYS[2:])
    s, g = max(float(pdf["_s"].iloc[0]), 1e-6), pdf["_g"].iloc[0]
    with np.errstate(all="ignore"):
        log = {k: np.where(x > 0, np.log(x), np.nan) for k, x in (("o", o), ("h", h), ("l", lo), ("c", c), ("v", v))}
        next_open, next_close = _next_good(log["o"], o > 0), _next_good(log["c"], c > 0)
        prev_close = _next_good(log["c"][::-1], (c > 0)[::-1])[::-1]
        # Away from the nearest thing known of both sides, in the same direction: far, and gone with the next reading.
        nearest = lambda x, *refs: (lambda d: np.take_along_axis(d, np.nanargmin(np.where(np.isnan(d), np.inf, np.abs(d)), axis=0)[None], 0)[0])(np.stack([x - r for r in refs]))
        left, right = nearest(log["c"], log["o"], prev_close), nearest(log["c"], next_open, next_close)
        close_dev = np.where(np.sign(left) == np.sign(right), np.minimum(np.abs(left), np.abs(right)), 0)
        around = np.fmax(np.fmax(log["o"], log["l"]), next_open)
        close_dev = np.nan_to_num(close_dev, nan=0.0, posinf=1e3)
        high_dev = np.nan_to_num(np.maximum(log["h"] - around, 0), nan=0.0, posinf=1e3)
        near = pd.Series(np.where(v > 0, log["v"], np.nan)).rolling(11, center=True, min_periods=1).median().to_numpy()
        base = np.fmax(near, float(g) if g is not None and not pd.isna(g) else near)
        volume_dev = np.nan_to_num(np.maximum(log["v"] - base, 0), nan=0.0, posinf=1e3)
        inf = {k: np.isposinf(x) for k, x in (("close", c), ("high", h), ("volume", v))}
        close_out, high_out, volume_out = (c <= 0) | inf["close"], (h <= 0) | inf["high"], (v < 0) | inf["volume"]
    flags = {}
    for field, x, dev, out in (("close", c, close_dev / s, close_out), ("volume", v, volume_dev, volume_out), ("high", h, high_dev / s, high_out)):
        known = ~np.isnan(x)
        if field == "high":  # a faulty close alone doesn't make the high impossible
            with np.errstate(all="ignore"):
                out = out | (h < np.fmax(o, lo)) | ((h < c) & ~flags["close"])
        same = _unchanged(x, known) & ~((field == "volume") & (x == 0)) & ~out
        p = posteriors(_emissions(dev, same, float(pdf[f"_p_{field}"].iloc[0]), out, known, field))
        flags[field] = known & (1 - p[:, NORMAL] > 0.5)
    own = pdf["_own"].to_numpy(bool) & (flags["close"] | flags["high"] | flags["volume"])
    kept = pdf.loc[own, KEYS].copy()
    for field in FIELDS:
        kept[f"bad_{field}"] = flags[field][own]
    return kept


def flag(df: DataFrame, size: int = 512, halo: int = 96) -> DataFrame:
    """Rows (bar_id, field_name) of implausible values of ``df`` (bar_id, time, symbol, open, high, low, close, volume)."""
    df = df.select("bar_id", *KEYS)
    known = F.col("time").isNotNull() & F.col("symbol").isNotNull()
    readings = df.where(known).select(*KEYS).groupBy(*KEYS).agg(F.lit(1).alias("_one")).drop("_one")
    rows, bases = ranked(readings, "symbol", KEYS[1:])
    usual = usual_behaviour(rows).join(usual_repeats(placed(rows, bases, "symbol")), "symbol")
    pieces = chunked(placed(rows, bases.join(usual, "symbol"), "symbol"), size, halo)
    types = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in KEYS) + ", bad_close boolean, bad_high boolean, bad_volume boolean"
    bad = pieces.groupBy("symbol", "_chunk").applyInPandas(flag_chunk, schema)
    same = None
    for k in KEYS:
        test = F.col(f"d.{k}") == F.col(f"b.{k}") if k in ("symbol", "time") else F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}"))
        same = test if same is None else same & test
    hit = df.where(known).alias("d").join(bad.alias("b"), same).select("d.bar_id", *[f"b.bad_{f}" for f in FIELDS])
    # Rows without a place in time or a source: the hard bounds alone.
    o, h, lo, c, v = (F.col(k) for k in KEYS[2:])
    low_high = (h < o) | (h < lo) | ((h < c) & (c > 0) & ~F.isnan(c))
    loose = df.where(~known).select(
        "bar_id", F.coalesce(_good(c) & (c <= 0), F.lit(False)).alias("bad_close"),
        F.coalesce(_good(h) & ((h <= 0) | F.coalesce(low_high, F.lit(False))), F.lit(False)).alias("bad_high"),
        F.coalesce(_good(v) & (v < 0), F.lit(False)).alias("bad_volume"),
    )
    both = hit.unionByName(loose)
    named = F.explode(F.array_compact(F.array(*[F.when(F.col(f"bad_{f}"), F.lit(f)) for f in FIELDS])))
    return both.select("bar_id", named.alias("field_name"))
