import random
from datetime import datetime, timedelta

import numpy as np

from pyspark.sql import functions as F

from bartide.operators import chunks, spikes

T0 = datetime(2025, 1, 1)
SCHEMA = "bar_id long, time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double, source string"


def series(n=900, seed=1):
    rnd, rows, price = random.Random(seed), [], 100.0
    for i in range(n):
        new = round(price * (1 + rnd.gauss(0, 0.001)), 3)
        hi, lo = max(price, new) * (1 + abs(rnd.gauss(0, 0.0003))), min(price, new) * (1 - abs(rnd.gauss(0, 0.0003)))
        rows.append([i, T0 + timedelta(minutes=i), "A", price, hi, lo, new, round(rnd.lognormvariate(5, 0.8), 3), "s"])
        price = new
    return rows


def found(spark, rows, **kw):
    return {(r.bar_id, r.field_name) for r in spikes.flag(spark.createDataFrame([tuple(r) for r in rows], SCHEMA), **kw).collect()}


def test_kinds_of_faults(spark):
    rows = series()
    rows[100][6] *= 100  # a faulty close alone: the high is not at fault
    rows[200][4] *= 1.2
    rows[300][7] = -5.0
    rows[310][6] = -1.0
    rows[320][4] = 0.0
    rows[330][4] = rows[330][3] * 0.99  # below the rest of its bar
    rows[400][7] *= 5000
    rows[500][6], rows[500][4] = rows[500][6] * 0.8, rows[500][4]
    for i in range(600, 615):
        rows[i][6] = rows[600][6]
    rows[700][6], rows[701][6] = None, float("nan")
    for i in range(750, 800):  # a busy hour
        rows[i][7] *= 8
    for i in range(820, 900):  # a lasting move, from the open of bar 820 on
        for k in (3, 4, 5, 6):
            rows[i][k] *= 1.3
    rows[820][3] /= 1.3
    rows.append([5000, *rows[100][1:8], "other"])  # another delivery of a faulty row
    rows.append([5001, None, "A", 1.0, 1.0, 1.0, -1.0, 1.0, "s"])
    rows.append([5002, T0, None, 1.0, 0.5, 1.0, 1.0, -1.0, "s"])
    want = {(100, "close"), (5000, "close"), (200, "high"), (300, "volume"), (310, "close"), (320, "high"), (330, "high"), (400, "volume"), (500, "close"), *((i, "close") for i in range(601, 615))}
    want |= {(5001, "close"), (5002, "high"), (5002, "volume")}
    assert found(spark, rows) ^ want == set()


def test_chunks_do_not_matter(spark):
    rows = series(1500, 5)
    for i in (255, 257, 511, 513, 768, 1023, 1498):
        rows[i][6] *= 1.5
    for i in range(700, 725):
        rows[i][7] = 3.25
    whole = found(spark, rows, size=100_000)
    assert found(spark, rows, size=256, halo=64) == whole
    assert {(i, "close") for i in (255, 257, 511, 513, 768, 1023, 1498)} <= whole and {(i, "volume") for i in range(701, 725)} <= whole


def test_uneven_repeats_and_chunks(spark):
    """A source whose stretches repeat differently has one rate of repeats, whatever the chunks."""
    rows, rnd = series(3000, 7), random.Random(3)
    for i in range(1, 3000):
        often = 0.9 if (i // 400) % 2 else 0.05
        if rnd.random() < often:
            rows[i][7] = rows[i - 1][7]
    whole = found(spark, rows, size=100_000)
    assert found(spark, rows, size=256, halo=128) == whole == found(spark, rows, size=512, halo=128)


def test_dense_readings_are_split(spark):
    """All readings in one second: chunks stay bounded, copies are those of the halo."""
    rows = series(4000, 8)
    for i, r in enumerate(rows):
        r[1] = T0 + timedelta(microseconds=200 * i)
    rows[2000][6] *= 2
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    held, bases = chunks.ranked(df, "symbol", ["time", "bar_id"])
    placed = chunks.placed(held, bases, "symbol")
    assert sorted((r._pos, r.bar_id) for r in placed.select("_pos", "bar_id").collect()) == [(i, i) for i in range(4000)]
    pieces = chunks.chunked(placed, 256, 64).groupBy("_chunk").agg(F.count("*").alias("n"), F.count_if("_own").alias("own")).collect()
    assert max(r.n for r in pieces) <= 384 and sum(r.own for r in pieces) == 4000 and sum(r.n for r in pieces) <= 6000
    assert (2000, "close") in found(spark, rows, size=256, halo=64)


def test_zero_volume_is_not_stuck_and_empty(spark):
    rows = series(300)
    for i in range(100, 160):
        rows[i][7] = 0.0
    assert found(spark, rows) == set()
    assert found(spark, []) == set()
    assert found(spark, rows[:1]) == set()


def test_posteriors_are_those_of_plain_forward_backward():
    rng = np.random.default_rng(0)
    emit = rng.random((40, 4)) ** 3 + 1e-6
    a = np.zeros((4, 4))
    for s in (0, 1, 3):
        a[s, 1], a[s, 2], a[s, 3] = (spikes.ENTER[k] for k in (spikes.SPIKE, spikes.STUCK, spikes.OUT))
        a[s, 0] = 1 - sum(spikes.ENTER.values())
    a[2] = [spikes.LEAVE_STUCK - 2e-3, 1e-3, 1 - spikes.LEAVE_STUCK, 1e-3]
    f = [a[0] * emit[0]]
    for e in emit[1:]:
        f.append((f[-1] @ a) * e)
    b = [a[:, 0]]
    for e in emit[:0:-1]:
        b.append(a @ (e * b[-1]))
    p = np.array(f) * np.array(b[::-1])
    np.testing.assert_allclose(spikes.posteriors(emit), p / p.sum(axis=1, keepdims=True), rtol=1e-8)
    assert spikes.posteriors(emit[:1]).shape == (1, 4)
