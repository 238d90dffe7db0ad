"""Irregular readings onto a regular grid by validity intervals.

Method: a reading's value holds from its time to the next reading of its source: the
readings are a step function. Each interval is intersected with the periods of the
windows that ask for it. A period gets the time-weighted mean of the values that are
still fresh (no older than ``hold_steps`` periods), the fraction of it that they
cover, its number of readings, and, where it has none, the last value known.

Sources are cut into blocks of time, so no task holds a whole source; what a block
inherits is the last reading of an earlier block, found on a table of one row per
source and block. Grid periods and contributions meet in one aggregation.

Defined results: readings with null time, null source or a null or NaN value don't
exist; several readings at one time count each, and the one with the largest ``order``
holds; a period without any earlier reading has null value and coverage 0; empty
tables give no rows (no readings: every period missing); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bartide.operators.chunks import epoch_us

US = 1_000_000


def regular(readings: DataFrame, windows: DataFrame, source: str = "symbol", time: str = "time", value: str = "close", order: str = "bar_id",
            block_s: int = 21_600, hold_steps: int = 1) -> DataFrame:
    """One row per period of ``windows`` (window_id, source, start_time, end_time, step_s):
    window_id, source, slot_s, n_readings, value, coverage, missing."""
    block = F.lit(block_s * US).cast("long")
    v = F.col(value).cast("double")
    read = readings.where(F.col(time).isNotNull() & F.col(source).isNotNull() & v.isNotNull() & ~F.isnan(v)).select(
        F.col(source).alias("_k"), epoch_us(time).alias("_t"), v.alias("_v"), F.col(order).alias("_o")
    )
    read = read.groupBy("_k", "_t").agg(F.max_by("_v", "_o").alias("_v"), F.count("*").alias("_n")).withColumn("_b", F.floor(F.col("_t") / block).cast("long"))

    w = windows.select("window_id", F.col(source).alias("_k"), epoch_us("start_time").alias("_w0"), epoch_us("end_time").alias("_we"), (F.col("step_s").cast("long") * US).alias("_step"))
    w = w.where((F.col("_we") > F.col("_w0")) & (F.col("_step") > 0)).withColumn("_slots", F.expr("(_we - _w0 + _step - 1) div _step"))
    w = w.withColumn("_w1", F.col("_w0") + F.col("_slots") * F.col("_step")).drop("_we")
    pieces = w.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_w0") / block).cast("long"), F.floor((F.col("_w1") - 1) / block).cast("long"))))

    # What each wanted block inherits from the blocks before it.
    last = read.groupBy("_k", "_b").agg(F.max(F.struct("_t", "_v")).alias("_last"))
    asked = pieces.select("_k", "_b").distinct()
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    inherited = asked.join(last, ["_k", "_b"], "full").withColumn("_in", F.last("_last", ignorenulls=True).over(before))
    inherited = inherited.join(asked, ["_k", "_b"], "left_semi").where(F.col("_in").isNotNull())
    carried = inherited.select("_k", (F.col("_b") * block).alias("_t"), F.col("_in._v").alias("_v"), F.lit(0).cast("long").alias("_n"), "_b", F.col("_in._t").alias("_t0"))

    own = read.join(asked, ["_k", "_b"], "left_semi").select("_k", "_t", "_v", "_n", "_b", F.col("_t").alias("_t0"))
    steps = own.unionByName(carried).withColumn("_next", F.lead("_t").over(Window.partitionBy("_k", "_b").orderBy("_t", "_n")))
    steps = steps.withColumn("_end", F.coalesce("_next", (F.col("_b") + 1) * block))

    met = steps.join(pieces, ["_k", "_b"])
    lo, hi = F.greatest("_t", "_w0"), F.least("_end", "_w1")
    met = met.withColumns({"_lo": lo, "_hi": hi}).where((F.col("_hi") > F.col("_lo")) | ((F.col("_n") > 0) & (F.col("_t") >= F.col("_w0")) & (F.col("_t") < F.col("_w1"))))
    met = met.withColumn("_slot", F.explode(F.expr("sequence((_lo - _w0) div _step, greatest(_hi - 1 - _w0, _lo - _w0) div _step)")))
    s0 = F.col("_w0") + F.col("_slot") * F.col("_step")
    fresh_to = F.least(F.col("_hi"), s0 + F.col("_step"), F.col("_t0") + hold_steps * F.col("_step"))
    length = F.greatest(fresh_to - F.greatest("_lo", s0), F.lit(0).cast("long"))
    counted = F.when((F.col("_t") >= s0) & (F.col("_t") < s0 + F.col("_step")), F.col("_n")).otherwise(0)
    given = met.select("window_id", "_k", "_w0", "_step", "_slot", length.alias("_len"), F.col("_v"), F.col("_t0"), counted.alias("_n"))

    # The grid itself, a block's share of each window at a time.
    first = F.expr("greatest(0L, (_b * {0} - _w0 + _step - 1) div _step)".format(block_s * US))
    after = F.expr("least(_slots, ((_b + 1) * {0} - _w0 + _step - 1) div _step)".format(block_s * US))
    grid = pieces.withColumns({"_f": first, "_a": after}).where(F.col("_a") > F.col("_f"))
    grid = grid.withColumn("_slot", F.explode(F.sequence(F.col("_f"), F.col("_a") - 1)))
    empty = grid.select("window_id", "_k", "_w0", "_step", "_slot", F.lit(0).cast("long").alias("_len"), F.lit(None).cast("double").alias("_v"), F.lit(None).cast("long").alias("_t0"), F.lit(0).cast("long").alias("_n"))

    out = given.unionByName(empty).groupBy("window_id", "_k", "_w0", "_step", "_slot").agg(
        F.sum("_n").alias("n_readings"), F.sum("_len").alias("_len"), F.sum(F.col("_v") * F.col("_len")).alias("_area"), F.max(F.struct("_t0", "_v")).alias("_known"),
    )
    mean = F.when(F.col("_len") > 0, F.col("_area") / F.col("_len"))
    return out.select(
        "window_id", F.col("_k").alias(source), ((F.col("_w0") + F.col("_slot") * F.col("_step")) / US).cast("long").alias("slot_s"),
        "n_readings", F.coalesce(mean, F.col("_known._v")).alias(value), (F.col("_len") / F.col("_step")).alias("coverage"), (F.col("n_readings") == 0).alias("missing"),
    )
