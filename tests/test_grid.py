import random
from datetime import datetime, timedelta

from bartide.operators import grid

T0 = datetime(2025, 1, 1)
READ = "bar_id long, symbol string, time timestamp_ntz, close double"
WIN = "window_id long, symbol string, start_time timestamp_ntz, end_time timestamp_ntz, step_s int"


def brute(readings, windows, hold=1):
    out = {}
    for w, sym, a, b, step in windows:
        mine = sorted((t, i, v) for i, s, t, v in readings if s == sym and t is not None and v is not None and v == v)
        last = {t: v for t, i, v in mine}
        times = sorted(last)
        k = 0
        while a + timedelta(seconds=k * step) < b:
            s0 = a + timedelta(seconds=k * step)
            s1 = s0 + timedelta(seconds=step)
            area = cover = 0.0
            for n, t in enumerate(times):
                end = times[n + 1] if n + 1 < len(times) else datetime.max
                lo, hi = max(t, s0), min(end, s1, t + timedelta(seconds=hold * step))
                if hi > lo:
                    cover += (hi - lo).total_seconds()
                    area += last[t] * (hi - lo).total_seconds()
            before = [last[t] for t in times if t < s1]
            value = area / cover if cover else (before[-1] if before else None)
            n = sum(s0 <= t < s1 for t, _, _ in mine)
            out[(w, int((s0 - datetime(1970, 1, 1)).total_seconds()))] = (n, None if value is None else round(value, 6), round(cover / step, 6), n == 0)
            k += 1
    return out


def run(spark, readings, windows, **kw):
    got = grid.regular(spark.createDataFrame(readings, READ), spark.createDataFrame(windows, WIN), **kw).collect()
    return {(r.window_id, r.slot_s): (r.n_readings, None if r.close is None else round(r.close, 6), round(r.coverage, 6), r.missing) for r in got}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    readings = [(i, rnd.choice("AB"), T0 + timedelta(seconds=rnd.randrange(40_000), microseconds=rnd.choice([0, 1, 999_999])), rnd.choice([1.0, 2.5, 7.0, None, float("nan")])) for i in range(300)]
    readings += readings[:20] + [(900, None, T0, 1.0), (901, "A", None, 1.0)]
    windows = [(1, "A", T0 + timedelta(seconds=17), T0 + timedelta(seconds=20_000), 600), (2, "A", T0 + timedelta(seconds=21_000), T0 + timedelta(seconds=45_001), 437), (3, "B", T0, T0 + timedelta(hours=13), 3600), (4, "C", T0, T0 + timedelta(hours=2), 1800)]
    assert run(spark, readings, windows) == brute(readings, windows)
    assert run(spark, readings, windows, block_s=1000, hold_steps=3) == brute(readings, windows, 3)


def test_ties_take_the_last(spark):
    got = run(spark, [(1, "A", T0, 1.0), (2, "A", T0, 3.0)], [(1, "A", T0, T0 + timedelta(seconds=60), 60)])
    assert list(got.values()) == [(2, 3.0, 1.0, False)]


def test_empty(spark):
    w = [(1, "A", T0, T0 + timedelta(seconds=120), 60)]
    assert list(run(spark, [], w).values()) == [(0, None, 0.0, True)] * 2
    assert run(spark, [(1, "A", T0, 1.0)], []) == {}
