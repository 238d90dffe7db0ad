import sys
import zipfile
from datetime import datetime, timedelta

from pyspark import cloudpickle
from pyspark.sql import functions as F

from bartide import __main__ as cli
from bartide.operators import gaps
from bartide.plans import pipelines
from bartide.registry import dataset
from bartide.sources import lake

cloudpickle.register_pickle_by_value(sys.modules[__name__])
START = 1735689600000  # 2025-01-01


def row(minute, volume=10.0):
    t = START + minute * 60_000
    return [t, 1, 2, 1, 1.5, volume, t + 59_999, 15, 3, 5, 7, 0]


def archive(folder, symbol, minutes, **kw):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / f"{symbol}-1m-2025-01-01.zip", "w") as z:
        z.writestr("x.csv", "\n".join(",".join(map(str, row(m, **kw))) for m in minutes))


def test_sync_repairs_and_fills(spark, tmp_path, capsys):
    spot, other = dataset("binance_spot_1m"), dataset("crypto_1m")
    archive(tmp_path / "spot", "AAA", [*range(0, 50), *range(55, 100), *range(130, 200)])
    archive(tmp_path / "fut", "AAA", range(0, 220), volume=5.0)
    pipelines.ingest_archives(spark, str(tmp_path / "fut"), str(tmp_path), other, "archive", "now")

    def fetch(symbol, start, end, limit):
        return [row(m) for m in range(0, 100) if start <= START + m * 60_000 <= end][:limit]

    done = pipelines.sync(spark, str(tmp_path / "spot"), str(tmp_path), spot, fetch, "archive", "now", other)
    assert done["archives"]["rows_written"] == 165 and done["repair"] == {"gaps": 2, "missing": 35, "rows_written": 5} and done["proxy"]["rows_written"] == 30
    assert done["audit"]["info"]["gaps"] == 0 and done["audit"]["row_count"] == 200
    filled = lake.scan(spark, str(tmp_path), spot).where("source = 'proxy_fill'").agg(F.count("*"), F.min("volume"), F.max("volume")).first()
    assert tuple(filled) == (30, 10.0, 10.0)
    assert pipelines.repair_gaps(spark, str(tmp_path), spot, fetch, "x", "now") == {"gaps": 0, "missing": 0, "rows_written": 0}
    cli.main(["latest", str(tmp_path), "binance_spot_1m"])
    assert "2025-01-01 03:19:00" in capsys.readouterr().out


def traded(folder, minutes, trades):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / "AAA-1m-2025-01-01.zip", "w") as z:
        z.writestr("x.csv", "\n".join(",".join(map(str, [*row(m)[:8], trades, *row(m)[9:]])) for m in minutes))


def test_filled_rows_are_whole(spark, tmp_path):
    spot, other = dataset("binance_spot_1m"), dataset("crypto_1m")
    archive(tmp_path / "spot", "AAA", [*range(0, 20), *range(25, 50)])
    # Ratio 1/2: 3 and 5 trades become 1.5 and 2.5, which are both 2.
    for name, minutes, trades in (("fut", [*range(0, 22), *range(24, 50)], 6), ("fut22", [22], 3), ("fut23", [23], 5)):
        traded(tmp_path / name, minutes, trades)
        pipelines.ingest_archives(spark, str(tmp_path / name), str(tmp_path), other, "archive", "then")
    done = pipelines.sync(spark, str(tmp_path / "spot"), str(tmp_path), spot, None, "archive", "now", other)
    assert done["proxy"]["rows_written"] == 5 and done["audit"]["info"]["gaps"] == 0
    rows = lake.scan(spark, str(tmp_path), spot).where("source = 'proxy_fill'").orderBy("time").collect()
    assert [r.number_of_trades for r in rows] == [3, 3, 2, 2, 3] and {r.ingested_at for r in rows} == {"now"}
    assert all((r.close_time - r.time).total_seconds() == 59.999 for r in rows)


def at(minute):
    return datetime(2025, 1, 1) + timedelta(minutes=minute)


def test_gaps_at_the_ends(spark):
    df = spark.createDataFrame([("A", at(m)) for m in (10, 11, 14)] + [("B", at(m)) for m in range(21)], "symbol string, time timestamp_ntz")
    symbols = spark.createDataFrame([("B",), ("C",)], "symbol string")
    found = lambda **kw: sorted((r.symbol, r.missing_start, r.missing_end, r.missing) for r in gaps.ranges(df, 60, **kw).collect())
    inner = ("A", at(12), at(13), 2)
    assert found() == [inner] and found(symbols=symbols) == [inner]
    assert found(start=at(0)) == [("A", at(0), at(9), 10), inner] and found(end=at(20)) == [inner, ("A", at(15), at(20), 6)]
    assert found(start=at(0), end=at(20), symbols=symbols) == [("A", at(0), at(9), 10), inner, ("A", at(15), at(20), 6), ("C", at(0), at(20), 21)]
    assert found(start=at(0), end=at(20), most_s=420) == [inner, ("A", at(15), at(20), 6)]


def test_sync_head_tail_and_unknown_symbols(spark, tmp_path):
    spot, other = dataset("binance_spot_1m"), dataset("crypto_1m")
    archive(tmp_path / "spot", "AAA", [*range(10, 30), *range(32, 50)])
    archive(tmp_path / "fut", "BBB", range(0, 60))
    pipelines.ingest_archives(spark, str(tmp_path / "fut"), str(tmp_path), other, "archive", "now")

    def fetch(symbol, start, end, limit):
        minutes = range(5, 60) if symbol == "BBB" else range(0, 60)
        return [row(m) for m in minutes if start <= START + m * 60_000 <= end][:limit]

    expected = {"start": at(0), "end": at(59), "symbols": ["AAA", "BBB"]}
    done = pipelines.sync(spark, str(tmp_path / "spot"), str(tmp_path), spot, fetch, "archive", "now", other, **expected)
    assert done["tail"]["rows_written"] == 115 and done["repair"] == {"gaps": 1, "missing": 5, "rows_written": 0} and done["proxy"]["rows_written"] == 5
    assert done["audit"]["info"]["gaps"] == 0 and done["audit"]["row_count"] == 120
    n = {r.symbol: r["count"] for r in lake.scan(spark, str(tmp_path), spot).groupBy("symbol").count().collect()}
    assert n == {"AAA": 60, "BBB": 60}
    (tmp_path / "none").mkdir()
    done = pipelines.sync(spark, str(tmp_path / "none"), str(tmp_path), spot, lambda *_: [], "archive", "now", start=at(-3), end=at(61), symbols=["CCC"])
    assert done["audit"]["info"]["gaps"] == 5 and not done["audit"]["valid"]
