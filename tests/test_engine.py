"""Golden values and properties of the engine's own operators."""

import gzip
import json
import zipfile
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bartide import api, registry, validate
from bartide.functions import calendar, market
from bartide.operators import clean, gaps, matrix, options, orderbook
from bartide.registry import Dataset, dataset
from bartide.schemas import BASE_CANDLE
from bartide.sources import archives, lake, rest, sinks
from bartide.streaming import events

T0 = datetime(2026, 6, 1, 9)


def candles(spark, rows):
    return spark.createDataFrame([(t, s, *map(float, ohlc), float(v), "x", "2026-06-01T00:00:00Z") for t, s, ohlc, v in rows], BASE_CANDLE)


def test_upsert_keeps_last(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [(T0, "TEST", [1] * 4, 10), (T0, "TEST", [2] * 4, 20), (T0 + timedelta(minutes=1), "TEST", [3] * 4, 30)]
    df = candles(spark, rows).withColumn("n", F.col("open").cast("long"))
    assert sinks.upsert(df, path, ["symbol", "time"], order="n")["rows_written"] == 3
    first = sorted(map(tuple, spark.read.parquet(path).select("time", "open").collect()))
    assert first == [(T0, 2.0), (T0 + timedelta(minutes=1), 3.0)]
    again = sinks.upsert(df, path, ["symbol", "time"], order="n")
    assert again["latest_time"] == T0 + timedelta(minutes=1)
    assert sorted(map(tuple, spark.read.parquet(path).select("time", "open").collect())) == first  # idempotent
    july = candles(spark, [(datetime(2026, 7, 1), "TEST", [9] * 4, 1), (None, "TEST", [9] * 4, 1)]).withColumn("n", F.lit(1).cast("long"))
    assert sinks.upsert(july, path, ["symbol", "time"], order="n")["rows_written"] == 1
    assert spark.read.parquet(path).count() == 3
    assert sinks.upsert(july.where("false"), path, ["symbol", "time"], order="n") == {"rows_written": 0, "latest_time": None}
    assert sinks.prune(spark, path, datetime(2026, 6, 30)) == {"touched": 1, "removed": 2}
    assert [r.open for r in spark.read.parquet(path).collect()] == [9.0]
    assert sinks.prune(spark, path, datetime(2026, 6, 30)) == {"touched": 0, "removed": 0}


def test_rows_without_an_order(spark, tmp_path):
    rows = [("A", 1, None), ("A", 2, 5), ("A", 3, 4), ("B", 4, None), ("C", 5, None), ("C", 6, None)]
    df = spark.createDataFrame(rows, "k string, v int, o int")
    last, first = ({r.k: r.v for r in keep(df, ["k"], "o").collect()} for keep in (clean.keep_last, clean.keep_first))
    assert last["A"] == 2 and first["A"] == 3 and last["B"] == first["B"] == 4 and last["C"] in (5, 6)
    assert {r.k: r.v for r in clean.keep_last(df.orderBy(F.desc("v")), ["k"], "o").collect()} == last  # ties are told by content
    raw = spark.createDataFrame([("1709251200000", "1", "2", "1", "1.5")], "open_time string, open string, high string, low string, close string")
    assert [(r.time, r.close, r.close_time) for r in clean.klines(raw, "A", "s", "now").collect()] == [(datetime(2024, 3, 1), 1.5, None)]
    path = str(tmp_path / "lake")
    sinks.upsert(candles(spark, [(T0, "A", [1] * 4, 1)]).withColumn("n", F.lit(None).cast("long")), path, ["symbol", "time"], order="n")
    sinks.upsert(candles(spark, [(T0, "A", [2] * 4, 1)]).withColumn("n", F.lit(None).cast("long")), path, ["symbol", "time"], order="n")
    assert [r.open for r in spark.read.parquet(path).collect()] == [2.0]


def test_an_upsert_reads_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [(T0 + timedelta(days=31 * i), s, [1] * 4, 1) for i in range(6) for s in ("A", "B/C d")]
    sinks.upsert(candles(spark, rows), path, ["symbol", "time"])
    new, folders = sinks._folders(candles(spark, [(T0, "B/C d", [3] * 4, 1), (T0, "new", [1] * 4, 1)]), "symbol", "time", "month")
    read = sinks.touched(spark, path, new, folders)
    assert len(read.inputFiles()) == 1 and [(r.symbol, r.time) for r in read.collect()] == [("B/C d", T0)]
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake").rglob("*.parquet")}
    sinks.upsert(candles(spark, [(T0, "B/C d", [3] * 4, 1)]), path, ["symbol", "time"])
    assert sum(f.exists() and f.stat().st_mtime_ns == t for f, t in before.items()) == len(before) - 1
    assert spark.read.parquet(path).where("open = 3").count() == 1 and spark.read.parquet(path).count() == 12


def test_normalise_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [(T0 + timedelta(seconds=7), "A", [10, 9, 11, 12], 1), (T0, "A", [1, 1, 1, 1], 1), (T0 + timedelta(days=40), "A", [1, 2, 1, 1], 1)]
    sinks.upsert(candles(spark, rows).withColumn("seq", F.col("open").cast("long")), path, ["symbol", "time"], order="seq")
    assert sinks.normalise(spark, path, "seq") == {"touched": 1, "off_rows": 1, "rows_removed": 1}
    got = sorted((r.time, r.high, r.low) for r in spark.read.parquet(path).collect())
    assert got == [(T0, 12.0, 9.0), (T0 + timedelta(days=40), 2.0, 1.0)]
    assert sinks.normalise(spark, path, "seq")["touched"] == 0


def test_klines_and_archives(spark, tmp_path):
    row = "1514764800000,13715.65000000,13715.65000000,13400.01000000,13556.15000000,45.98000000,1514764859999,624000.5,559,20.10000000,273000.0,0"
    late = row.replace("1514764800000", "1514764860003").replace("1514764859999", "1514764919999")
    head = "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"
    for name, text in (("a", f"{row}\n{late}\n"), ("b", f"{head}\n{row}\n")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr(f"{name}.csv", text)
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    raw, errors = archives.split_errors(archives.read_zips(spark, str(tmp_path), archives.KLINE_COLUMNS))
    assert [(r.archive[-10:], r.error.split(":")[0]) for r in errors.collect()] == [("broken.zip", "BadZipFile")]
    assert sorted((r.archive[-5:], r.number_of_trades) for r in raw.collect()) == [("a.zip", "559"), ("a.zip", "559"), ("b.zip", "559")]
    got = clean.klines(raw.where(F.col("archive").endswith("a.zip")), "BTCUSDT", "archive", "now").orderBy("time").collect()
    assert [r.time for r in got] == [datetime(2018, 1, 1), datetime(2018, 1, 1, 0, 1)]
    assert got[0].symbol == "BTCUSDT" and got[0].volume == pytest.approx(45.98) and got[0].number_of_trades == 559 and tuple(raw.limit(0).columns)[0] == "archive"
    assert tuple(got[0].asDict()) == clean.CANDLE_COLUMNS
    keys = spark.createDataFrame([("d/BTCUSDT_240329-1m-2024-03.zip",), ("d/BTCUSDT-1m-2024-03-15.zip",), ("d/other.txt",)], "key string")
    parts = keys.select(*[c.alias(n) for n, c in archives.key_parts(F.col("key")).items()]).collect()
    assert [(r.symbol, r.date) for r in parts] == [("BTCUSDT_240329", date(2024, 3, 1)), ("BTCUSDT", date(2024, 3, 15)), (None, None)]
    stored = spark.createDataFrame([("BTCUSDT", date(2024, 3, 15))], "symbol string, date date")
    assert [r.symbol for r in archives.wanted_keys(keys, "key", "2024-03-01", "2024-03-31", stored).collect()] == ["BTCUSDT_240329"]
    nothing = stored.limit(0)  # a month counts if it is that of the start; a day only from the start on
    assert sorted(r.symbol for r in archives.wanted_keys(keys, "key", "2024-03-15", "2024-03-31", nothing).collect()) == ["BTCUSDT", "BTCUSDT_240329"]
    assert [r.symbol for r in archives.wanted_keys(keys, "key", "2024-03-16", "2024-03-31", nothing).collect()] == ["BTCUSDT_240329"]


def test_aliases_and_delivery(spark):
    raw = spark.createDataFrame([("1709251200000", "62110.8", "62163.7", "62088.5", "62162.9", "1.805", "1709251259999", "112127.0301", "84", "1.210", "75170.5038")],
                                "open_time string, open string, high string, low string, close string, volume string, close_time string, quote_volume string, count string, taker_buy_volume string, taker_buy_quote_volume string")
    r = clean.klines(raw, "BTCUSDT_240329", "archive", "now", floor_s=None).first()
    assert (r.number_of_trades, r.time) == (84, datetime(2024, 3, 1)) and r.taker_buy_base_volume == pytest.approx(1.21)
    d = spark.createDataFrame([("BTCUSDT_240329",), ("BTCUSDT",)], "s string").select(market.delivery_date(F.col("s")).alias("d"))
    assert [r.d for r in d.collect()] == [date(2024, 3, 29), None]


def test_rest_pages(spark):
    def fetch(symbol, start, end, limit):
        return [[t, 1, 1, 1, 1, 1, t + 59_999, 1, 1, 1, 1, 0] for t in range(start - start % 60_000 + (60_000 if start % 60_000 else 0), end + 1, 60_000)][:limit]

    df = rest.klines(spark, fetch, ["A", "B"], 0, 3_600_000 * 5 - 1, limit=7, slice_ms=3_600_000)
    assert df.count() == df.distinct().count() == 600


def test_book_depth(spark):
    rows = [(p, d, n, s) for s, k in ((datetime(2026, 7, 11, 0, 0, 3), 0), (datetime(2026, 7, 11, 0, 59, 33), 1)) for p, d, n in ([(-1.0, 10, 1000), (1.0, 12, 1200), (-0.2, 3, 300), (0.2, 4, 400)] if not k else [(-1.0, 20, 2000), (1.0, 30, 3000), (-0.2, 7, 700), (0.2, 8, 800)])]
    df = spark.createDataFrame([(float(p), float(d), float(n), s) for p, d, n, s in rows], "percentage double, depth double, notional double, sample_time timestamp_ntz")
    df = df.withColumns({"symbol": F.lit("X"), "time": market.floor_time(F.col("sample_time"), 3600), "seq": F.monotonically_increasing_id()})
    (r,) = orderbook.hourly(df, [0.002, 0.01], 0.01, "seq").collect()
    assert (r.time, r.sample_time) == (datetime(2026, 7, 11), datetime(2026, 7, 11, 0, 59, 33))
    assert (r.bid_depth_1pct, r.ask_depth_1pct, r.bid_notional_1pct, r.ask_notional_1pct, r.bid_depth_0_2pct) == (20, 30, 2000, 3000, 7)
    assert r.primary_imbalance == pytest.approx(-0.2) and set(orderbook.schema_columns([0.002, 0.01])) <= set(r.asDict())


def test_live_book(spark):
    df = spark.createDataFrame([([(99.0, 2.0), (98.0, 3.0), (90.0, 10.0)], [(101.0, 4.0), (102.0, 5.0), (110.0, 10.0)]), ([], [(1.0, 1.0)])], "bids array<struct<price: double, qty: double>>, asks array<struct<price: double, qty: double>>")
    a, b = orderbook.bands_from_levels(df, [0.01, 0.05], 0.01).collect()
    assert (a.mid_price, a.bid_depth_1pct, a.ask_depth_1pct, a.bid_notional_1pct, a.ask_notional_1pct, a.bid_depth_5pct, a.ask_depth_5pct) == (100, 2, 4, 198, 404, 5, 9)
    assert b.mid_price is None and b.spread_bps is None


def test_scores(spark):
    rows = [("OLDUSDT", 200.0, date(2020, 1, 1), 2.0), ("MIDUSDT", 100.0, date(2021, 1, 1), 3.0), ("NEWUSDT", 300.0, date(2025, 6, 17), 1.0)]
    df = spark.createDataFrame(rows, "symbol string, quote_volume double, onboard date, stability double").withColumn("age", F.datediff(F.lit("2026-06-17").cast("date"), "onboard"))
    top = clean.scored(df, {"quote_volume": 0.5, "age": 0.3, "stability": 0.2}).orderBy(F.desc("score"), F.desc("quote_volume")).first()
    assert top.symbol == "OLDUSDT"
    v = spark.createDataFrame([("A", 100.0 + i) for i in range(100)] + [("B", 1.0)] * 5, "symbol string, volume double")
    got = {r.symbol: r.stability for r in clean.stability(v, "symbol", "volume").collect()}
    assert got["A"] > 0 and got["B"] == 0
    ranks = clean.average_rank(spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "x double"), "x", "r").orderBy("x").collect()
    assert [r.r for r in ranks] == [0.25, 0.625, 0.625, 1.0]


def test_bounds_null_and_nan(spark):
    df = spark.createDataFrame([(10.0, 9.0, 11.0, 12.0), (1.0, None, 1.0, 1.0), (1.0, 2.0, 1.0, float("nan"))], "open double, high double, low double, close double")
    assert [(r.high, r.low) for r in clean.repair_bounds(df).collect()] == [(12.0, 9.0), (None, None), (None, None)]


def test_gap_fill_completes(spark):
    times = [T0 + timedelta(minutes=m) for m in (0, 1, 5, 6, 2000, 2001)]
    df = spark.createDataFrame([("A", t) for t in times] + [("A", None), (None, T0)], "symbol string, time timestamp_ntz")
    g = gaps.ranges(df, 60)
    assert sorted((r.missing, r.missing_start) for r in g.collect()) == [(3, T0 + timedelta(minutes=2)), (1993, T0 + timedelta(minutes=7))]
    whole = df.unionByName(gaps.missing_times(g, 60))
    assert gaps.ranges(whole, 60).count() == 0 and gaps.scan(whole, 60).first().n_gaps == 0


def test_matrix_roundtrip(spark):
    df = spark.createDataFrame([(T0, "A", 1.0), (T0, "B", 2.0), (T0 + timedelta(days=1), "A", 3.0)], "time timestamp_ntz, symbol string, close double")
    wide = matrix.pivot(df, ["B", "A", "C"], "close")
    assert wide.columns == ["time", "B", "A", "C"]
    assert matrix.unpivot(wide, "close").select("time", "symbol", "close").exceptAll(df).count() == 0
    assert matrix.select_symbols(wide, ["A", "Z", "B"]).columns == ["time", "A", "B"]


def test_validation(spark):
    ok = candles(spark, [(T0 + timedelta(minutes=i), "A", [1, 2, 1, 1], 1) for i in range(3)])
    assert validate.report(ok, "crypto_1m")["valid"]
    bad = candles(spark, [(T0, "A", [1, 0.5, 1, 1], -1), (T0, "A", [1, 2, 1, 1], 1), (T0 + timedelta(minutes=9), "A", [1, 2, 1, 1], 1)])
    r = validate.report(bad, "binance_spot_1m")
    assert not r["valid"] and r["row_count"] == 3 and r["info"]["gaps"] == 1 and any("high < low" in e for e in r["errors"]) and any("duplicate" in e for e in r["errors"])
    assert validate.report(ok.drop("close"), "crypto_1m")["errors"] == ["missing columns: ['close']"]
    assert "not numeric" in validate.report(ok.withColumn("close", F.lit("x")), "crypto_1m")["errors"][0]
    assert validate.report(ok.where("false"), "crypto_1m")["errors"] == ["no rows"]
    assert validate.report(matrix.pivot(ok, ["A"], "close"), "vn_daily_matrix")["info"]["shape"] == (3, 1)
    book = spark.createDataFrame([(T0, "A", 1.0), (T0, "A", -1.0)], "time timestamp_ntz, symbol string, bid_depth_1pct double")
    assert len(validate.report(book, "orderbook_snapshot_1h")["errors"]) == 2


def test_loading(spark, tmp_path):
    ds = dataset("BINANCE_SPOT_1M")
    rows = [(datetime(2025, 12, 31, 23, 59) + timedelta(minutes=i), s, [1, 2, 1, 1.5], 2.345678) for i in range(3) for s in ("BBB", "AAA")]
    sinks.upsert(candles(spark, rows), f"{tmp_path}/{ds.path}", ["symbol", "time"])
    read = api.Reader(spark, str(tmp_path))
    got = read.load("crypto_spot_1m", " aaa ", "2026-01-01", "2026-01-01 00:01:00")
    assert [(r.symbol, r.time, r.volume) for r in got.collect()] == [("AAA", datetime(2026, 1, 1), 2.345678), ("AAA", datetime(2026, 1, 1, 0, 1), 2.345678)]
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters")[1]
    assert read.load("crypto_spot_1m", limit=3).count() == 3 and read.load("crypto_spot_1m", end="2025-12-31").count() == 0
    assert sorted(r.symbol for r in lake.discover(spark, str(tmp_path), ds).collect()) == ["AAA", "BBB"]
    assert {r.symbol: r.latest_time for r in lake.latest(spark, str(tmp_path), ds).collect()}["AAA"] == datetime(2026, 1, 1, 0, 1)
    (tmp_path / ds.path / "symbol=AAA").rename(tmp_path / ds.path / "symbol=aaa")
    assert read.load("crypto_spot_1m", "Aaa").count() == 3 == read.load_features("crypto_spot_1m", ["bbb"]).count()
    registry.register(replace(ds, name="hooked", aliases=(), normalise=lambda df: df.withColumn("close", F.lit("7"))))
    assert {r.close for r in read.load("hooked").collect()} == {7.0}
    with pytest.raises(ValueError):
        read.load("nothing")
    with pytest.raises(ValueError):
        read.load("vn_daily_matrix")
    m = Dataset("m", "m", kind="matrix")
    candles(spark, rows).write.parquet(f"{tmp_path}/m")
    wide = read.wide(m, "close", ["BBB", "AAA"], limit=2)
    assert wide.columns == ["time", "BBB", "AAA"] and wide.count() == 2
    candles(spark, rows).write.parquet(f"{tmp_path}/matrix/vn")
    assert read.ohlcv("vn_daily_matrix", "AAA").count() == 3


def test_csv_headers_that_drift(spark, tmp_path):
    (tmp_path / "symbol=A").mkdir()
    (tmp_path / "symbol=A/one.csv").write_text("time,symbol,open,volume\n2026-01-01 00:00:00,A,1.5,10\n")
    (tmp_path / "symbol=A/two.csv").write_text("volume,open,time,symbol,extra\n20,2.5,2026-01-02 00:00:00,A,z\nbad,3.5,,A,z\n")
    with gzip.open(tmp_path / "symbol=A/three.csv.gz", "wt") as f:
        f.write("time,open\n2026-01-03,9\n")
    (tmp_path / "symbol=A/torn.csv.gz").write_bytes((tmp_path / "symbol=A/three.csv.gz").read_bytes()[:20])
    (tmp_path / "symbol=A/none.csv").write_text("")
    got, rejects = lake.csv_by_header(spark, str(tmp_path), {"time": "timestamp_ntz", "symbol": "string", "open": "double", "volume": "double", "close": "double"})
    assert sorted((r.open, r.volume, r.close) for r in got.collect() if r.volume) == [(1.5, 10.0, None), (2.5, 20.0, None)] and got.count() == 4
    assert [(r.path.rsplit("/", 1)[1], bool(r.error)) for r in rejects.collect()] == [("torn.csv.gz", True)]
    (tmp_path / "w.txt").write_text("date,AAA,BBB\n2026-01-01,1,\n2026-01-02,x,2\n")
    assert sorted((r.symbol, r.close) for r in lake.wide_csv(spark, str(tmp_path / "w.txt"), "close").collect()) == [("AAA", 1.0), ("BBB", 2.0)]


def test_options(spark):
    df = spark.createDataFrame([("BTC-260626-100000-C", 0.5), ("BTC-260626-90000.5-P", -0.2), ("BTC-269926-1-C", 0.1), ("junk", 0.1)], "symbol string, delta double")
    got = options.parsed(df).orderBy("symbol").collect()
    assert [(r.underlying, r.expiry, r.strike, r.type) for r in got] == [("BTC", date(2026, 6, 26), 100000.0, "C"), ("BTC", date(2026, 6, 26), 90000.5, "P")]
    spots = spark.createDataFrame([("BTC", 1.0)], "underlying string, spot double")
    tick = spark.createDataFrame([("BTC-260626-100000-C", 7.0, 1), ("BTC-260626-100000-C", 8.0, 2)], "symbol string, last double, seq int")
    s = options.snapshot(df, tick, spots, "seq", 2, F.lit("2026-01-01").cast("date"), (0.3, 0.9)).collect()
    assert [(r.ticker_last, r.mark_delta, r.spot) for r in s] == [(8.0, 0.5, 1.0)]


def test_calendar_and_tokens(spark):
    t = [datetime(2026, 6, 1, 9, 0), datetime(2026, 6, 1, 11, 30), datetime(2026, 6, 1, 11, 31), datetime(2026, 6, 1, 14, 45), datetime(2026, 6, 6, 10), datetime(2026, 4, 30, 10), datetime(2026, 6, 1, 8, 50)]
    df = spark.createDataFrame([(x,) for x in t], "time timestamp_ntz")
    assert {r.time for r in calendar.trading_hours(df, "time", calendar.holidays(spark)).collect()} == {t[0], t[1], t[3]}
    assert calendar.trading_hours(df, "time", calendar.holidays(spark), calendar.DERIVATIVE_SESSIONS).count() == 4
    assert calendar.next_session(df, "time", F.lit(t[1]).cast("timestamp_ntz")).first()[0] == t[2]
    assert (market.band_token(0.01), market.band_token(0.002)) == ("1pct", "0_2pct")


def test_columnar_bars(spark):
    df = spark.createDataFrame([("A", '{"t":[1709251200,1709251260],"o":[1,2],"h":[1,2],"l":[1,2],"c":[1,2.5],"v":[5,6]}')], "symbol string, p string")
    assert [(r.time, r.close, r.volume) for r in clean.ohlc_columns(df, "p").collect()] == [(datetime(2024, 3, 1), 1.0, 5.0), (datetime(2024, 3, 1, 0, 1), 2.5, 6.0)]


def test_stream_events(spark, tmp_path):
    quote = {"T": "q", "symbol": "FPT", "marketId": "HOSE", "boardId": "G1", "isin": "x", "bid": [{"price": 10.0, "qtty": 5}], "offer": [], "totalBidQtty": 5}
    bar = {"T": "b", "symbol": "FPT", "boardId": "G1", "time": "1709251200", "open": 1, "high": 2, "low": 1, "close": 1.5, "volume": 3, "resolution": "1"}
    raw = spark.createDataFrame([(json.dumps(x),) for x in (quote, bar)] + [("{broken",), (None,)], "payload string")
    q = events.book_edges(events.parsed(raw, "quote")).collect()
    assert [(r.best_bid, r.best_ask, r.spread) for r in q] == [(10.0, None, None)]
    b = events.subscribed(events.parsed(raw, "ohlc"), ["fpt"], ["G1"]).collect()
    assert b[0].close == 1.5 and b[0].time == datetime(2024, 3, 1) and events.subscribed(events.parsed(raw, "ohlc"), boards=["T1"]).count() == 0
    src = tmp_path / "src"
    candles(spark, [(T0 + timedelta(minutes=i), "A", [i + 1] * 4, 1) for i in range(5)]).coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema(BASE_CANDLE).parquet(str(src))
    for _ in range(2):  # a replay changes nothing
        events.run_available(stream, str(tmp_path / f"c{_}"), batch=events.upsert_to(str(tmp_path / "lake"), ["symbol", "time"]))
        assert spark.read.parquet(str(tmp_path / "lake")).count() == 5


def test_state(spark, tmp_path):
    s = sinks.State(spark, str(tmp_path / "s.json"))
    s.update("A", latest="x")
    assert s.update("A", n=1, latest=None)["A"] == {"latest": "x", "n": 1}
    (tmp_path / "s.json").write_text("{broken")
    assert s.read() == {} and (tmp_path / "s.json.corrupt").exists()
