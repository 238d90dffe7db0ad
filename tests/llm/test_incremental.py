import random
from datetime import datetime, timedelta

from bartide.llm import incremental as inc

T0 = datetime(2025, 3, 1)
HIST = "bar_id long, time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double"
BATCH = HIST.replace("bar_id", "in_id")


def same(a, b):
    if a[1] is None or b[1] is None or a[2] is None or b[2] is None or abs((a[1] - b[1]).total_seconds()) > 10:
        return False
    key = lambda s: "".join(c for c in s.upper() if c.isalnum())
    if key(a[2]) != key(b[2]) or not key(a[2]):
        return False
    for x, y, r in zip(a[3:], b[3:], (0.001,) * 4 + (0.01,)):
        if x is None or y is None or x != x or y != y:
            continue
        if abs(x - y) > r * max(abs(x), abs(y)):
            return False
    return True


def brute(hist, batch):
    accepted, out = list(hist), set()
    for row in sorted(batch):
        hits = [a[0] for a in accepted if same(a, row)]
        if hits:
            out.add((min(hits), row[0]))
        else:
            accepted.append(row)
    return out


def rows(n, start, seed):
    rnd = random.Random(seed)

    def bar(i):
        p = rnd.choice([100.0, 100.05, 100.12, 100.2])
        v = rnd.choice([50.0, 50.3, 50.7, 51.0, None])
        t = rnd.choice([T0 + timedelta(seconds=rnd.choice([0, 4, 9, 14, 55, 62, 70, 86_395, 86_404]), microseconds=rnd.choice([0, 500_000])), None if rnd.random() < 0.1 else T0])
        return (start + i, t, rnd.choice(["AB", "ab ", "A-B", "CD", None if rnd.random() < 0.2 else "AB"]), p, p, p, rnd.choice([p, p, None, float("nan")]), v)

    return [bar(i) for i in range(n)]


def found(spark, hist, *batches):
    index = inc.build(spark.createDataFrame(hist, HIST))
    out = set()
    for b in batches:
        out |= {tuple(r) for r in inc.dedup(index, spark.createDataFrame(b, BATCH)).collect()}
    return out


def test_against_brute_force_at_once_and_batch_by_batch(spark):
    for seed in (1, 2):
        hist, batch = rows(25, 1, seed), rows(70, 1000, seed + 10)
        want = brute(hist, batch)
        assert found(spark, hist, batch) == want
        assert found(spark, hist, batch[:30], batch[30:31], batch[31:]) == want


def test_chain_is_settled_in_order(spark):
    chain = [(1000 + i, T0 + timedelta(seconds=7 * i), "AB", 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(9)]
    assert found(spark, [], chain) == brute([], chain) == {(1000, 1001), (1002, 1003), (1004, 1005), (1006, 1007)}


def test_hot_copies_empty_and_odd_rows(spark):
    hot = [(1000 + i, T0, "AB", 1.0, 1.0, 1.0, None, 1.0) for i in range(2000)]
    got = found(spark, [], hot)
    assert len(got) == 1999 and {k for k, _ in got} == {1000}
    assert found(spark, [], []) == set() == found(spark, hot[:1], [])
    wide = [(5000, T0, "ＡＢ", 1.0, 1.0, 1.0, 1.0, 1.0), (5001, T0, " - ", 1.0, 1.0, 1.0, 1.0, 1.0), (5002, T0, " - ", 1.0, 1.0, 1.0, 1.0, 1.0)]
    assert found(spark, hot[:1], wide) == {(1000, 5000)}


def test_sessions_share_an_index(spark, tmp_path):
    hist, batch = rows(25, 1, 3), rows(60, 1000, 13)
    want, path = brute(hist, batch), str(tmp_path / "cells")
    inc.build(spark.newSession().createDataFrame(hist, HIST), path=path)

    def add(part, name):
        own = spark.newSession()
        return {tuple(r) for r in inc.dedup(inc.CellIndex(own, path), own.createDataFrame(part, BATCH), batch=name).collect()}

    held = lambda: sorted(map(tuple, spark.read.parquet(path).select("id", "batch").collect()))
    first = add(batch[:30], "a")
    before = held()
    assert add(batch[:30], "a") == first and held() == before  # a retry finds and leaves the same
    assert first | add(batch[30:], "b") == want
    assert {i for i, _ in held()} == {r[0] for r in hist if r[1] and r[2] and inc_key(r)} - copies(hist) | {r[0] for r in batch if r[1] and r[2] and inc_key(r)} - {i for _, i in want}


def inc_key(r):
    return any(c.isalnum() for c in r[2])


def copies(hist):
    """Ids of exact copies of an earlier bar."""
    seen, out = set(), set()
    for r in sorted(hist):
        key = ("".join(c for c in (r[2] or "").upper() if c.isalnum()), r[1], *[None if x is None or x != x else x for x in r[3:]])
        (out.add(r[0]) if key in seen else seen.add(key))
    return out


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    bar = lambda i: [(i, T0, "AB", 1.0, 1.0, 1.0, 1.0, 1.0)]
    index = inc.build(spark.createDataFrame(bar(1), HIST), path=str(tmp_path / "cells"))
    assert [tuple(r) for r in inc.dedup(index, spark.createDataFrame(bar(7), BATCH), batch="x").collect()] == [(1, 7)]
    index.append(inc.vectors(spark.createDataFrame(bar(0), HIST), "bar_id"), "lost")
    inc.files.touch(spark, index._marker("lost"))
    assert [tuple(r) for r in inc.dedup(index, spark.createDataFrame(bar(8), BATCH), batch="y").collect()] == [(1, 8)]


def test_a_batch_reads_only_its_days(spark):
    days = [(i, T0 + timedelta(days=i), "AB", 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(30)]
    index = inc.build(spark.createDataFrame(days, HIST))
    nodes = inc.vectors(spark.createDataFrame([(99, T0 + timedelta(days=3), "AB", 1.0, 1.0, 1.0, 1.0, 1.0)], BATCH), "in_id")
    read = {r.f for r in index.candidates(inc._probes(nodes)).selectExpr("_metadata.file_path as f").distinct().collect()}
    assert 1 <= len(read) <= 2 and index.nearest(nodes).first().kept == 3
