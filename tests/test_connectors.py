"""Connectors, seeding, audits, sessions: what has no table to be compared on."""

import io
import json
import struct
import sys
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from bartide import validate
from bartide.functions import calendar, market, signing
from bartide.operators import clean, gaps, matrix, orderbook
from bartide.plans import pipelines
from bartide.registry import dataset
from bartide.sources import archives, lake, rest, seed, sinks
from bartide.streaming import events, msgpack, source

cloudpickle.register_pickle_by_value(sys.modules[__name__])
T0 = datetime(2025, 1, 1)
START = 1735689600000


def packed(x) -> bytes:
    """MessagePack of a value, by the specification."""
    if x is None or isinstance(x, bool):
        return {None: b"\xc0", False: b"\xc2", True: b"\xc3"}[x]
    if isinstance(x, int):
        for low, high, first, form in ((0, 127, b"", ">B"), (-32, -1, b"", ">b"), (0, 255, b"\xcc", ">B"), (0, 2**16 - 1, b"\xcd", ">H"), (0, 2**32 - 1, b"\xce", ">I"), (0, 2**64 - 1, b"\xcf", ">Q"), (-128, 0, b"\xd0", ">b"), (-(2**15), 0, b"\xd1", ">h"), (-(2**31), 0, b"\xd2", ">i")):
            if low <= x <= high:
                return first + struct.pack(form, x)
        return b"\xd3" + struct.pack(">q", x)
    if isinstance(x, float):
        return b"\xcb" + struct.pack(">d", x)
    if isinstance(x, str):
        raw = x.encode()
        return (bytes([0xA0 | len(raw)]) if len(raw) < 32 else b"\xd9" + bytes([len(raw)]) if len(raw) < 256 else b"\xda" + struct.pack(">H", len(raw))) + raw
    if isinstance(x, bytes):
        return b"\xc4" + bytes([len(x)]) + x
    items = [packed(v) for kv in x.items() for v in kv] if isinstance(x, dict) else [packed(v) for v in x]
    n, small, wide = len(x), (0x80 if isinstance(x, dict) else 0x90), (b"\xde" if isinstance(x, dict) else b"\xdc")
    return (bytes([small | n]) if n < 16 else wide + struct.pack(">H", n)) + b"".join(items)


def test_msgpack():
    values = [0, 127, 128, 255, 256, 65_535, 65_536, 2**32, 2**63, -1, -32, -33, -129, -40_000, -(2**40), 1.5, None, True, False, "", "é" * 10, "x" * 100, "y" * 1000, b"\x00\x01", [], list(range(40)), {"a": [1, {"b": None}]}, {str(i): i for i in range(20)}]
    for v in values:
        assert msgpack.decoded(packed(v)) == v
    assert list(msgpack.all_values(b"".join(map(packed, values)))) == values
    for bad in (b"", b"\xc1", packed("abc")[:-1], packed([1, 2])[:-1], packed(1) + b"\x00"):
        with pytest.raises(ValueError):
            msgpack.decoded(bad)
    assert msgpack.decoded(b"\xca" + struct.pack(">f", 0.5)) == 0.5 and msgpack.decoded(b"\xd4\x05\x07") == {"extension": 5, "data": b"\x07"}


class Link:
    """A feed of numbered messages that breaks after every third."""

    opened, number = [], 0

    def __init__(self):
        self.sent, self.left = [], 3
        Link.opened.append(self)

    def send(self, message):
        self.sent.append(message)

    def receive(self, seconds):
        if not self.left:
            raise OSError("gone")
        self.left -= 1
        Link.number += 1
        m = {"T": "t", "symbol": "AAA", "boardId": "G1", "time": str(1735689600 + Link.number), "matchPrice": Link.number}
        return packed(m) if Link.number % 2 else json.dumps(m)

    def close(self):
        pass


def test_session_reconnects_and_subscribes_again():
    s = source.Subscription()
    assert s.subscribe("trade", ["aaa ", "BBB"], ["G1", "G3"]) == [{"action": "subscribe", "channel": "trade", "board": b, "symbols": ["AAA", "BBB"]} for b in ("G1", "G3")]
    assert s.subscribe("trade", "AAA", ["G1"]) == [] and s.subscribe("orders") == [{"action": "subscribe", "channel": "orders"}]
    assert s.unsubscribe("trade", "BBB", ["G3"]) == [{"action": "unsubscribe", "channel": "trade", "board": "G3", "symbols": ["BBB"]}]
    with pytest.raises(ValueError):
        s.subscribe("trade")
    Link.opened, Link.number = [], 0
    session = source.Session(Link, s, {"auth": 1})
    got = list(session.take(7, 5))
    assert [json.loads(m)["matchPrice"] for m, _ in got] == list(range(1, 8)) and len(Link.opened) == 3 and session.reconnections == 2
    assert all(link.sent == [{"auth": 1}, *s.again()] for link in Link.opened) and session.healthy
    waits, tries = [], []

    def refuse():
        tries.append(1)
        raise ConnectionRefusedError

    with pytest.raises(OSError):
        source.Session(refuse, s, attempts=9, sleep=waits.append).open()
    assert waits == [1, 2, 4, 8, 16, 32, 60, 60] and len(tries) == 9
    assert source.as_json(b"\xc1") == '{"undecoded": "c1"}' and json.loads(source.as_json(b'{"a": 1}')) == {"a": 1}


def test_feed_reader_replays_what_it_took(tmp_path):
    Link.opened, Link.number = [], 0
    sys.modules["feed_of_tests"] = sys.modules[__name__]
    reader = source.FeedReader({"transport": "feed_of_tests:Link", "folder": str(tmp_path), "symbols": "AAA", "most": "4", "seconds": "5"})
    rows, at = reader.read(reader.initialOffset())
    rows = list(rows)
    more, end = reader.read(at)
    assert len(rows) == 4 and at == {"at": 4} and end == {"at": 8}
    assert list(reader.readBetweenOffsets({"at": 0}, end)) == rows + list(more)
    reader.commit(at)
    assert [p.name for p in tmp_path.iterdir()] == [f"{4:020d}.jsonl"]
    assert Link.opened[0].sent == [{"action": "subscribe", "channel": "trade", "symbols": ["AAA"]}]


def test_feed_as_a_stream(spark, tmp_path):
    folder = tmp_path / "code"
    folder.mkdir()
    (folder / "numbered_feed.py").write_text(
        "import json\nclass Link:\n    n = 0\n    def send(self, m): pass\n    def close(self): pass\n    def receive(self, s):\n        Link.n += 1\n        return json.dumps({'T': 't', 'symbol': 'AAA', 'boardId': 'G1', 'time': '1735689600', 'matchPrice': Link.n}) if Link.n <= 6 else None\n"
    )
    import os

    old = os.environ.get("PYTHONPATH", "")
    os.environ["PYTHONPATH"] = f"{folder}:{os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}:{old}"
    spark.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]
    sys.path.insert(0, str(folder))
    try:
        raw = source.feed(spark, "numbered_feed:Link", str(tmp_path / "kept"), ["AAA"], seconds="0.5")
        out = events.parsed(raw, "trade").select("symbol", "matchPrice", "received_at")
        q = out.writeStream.format("memory").queryName("numbered").option("checkpointLocation", str(tmp_path / "c")).start()
        for _ in range(60):
            if spark.table("numbered").count() >= 6:
                break
            q.awaitTermination(1)
        q.stop()
        assert sorted(r.matchPrice for r in spark.table("numbered").collect()) == [1, 2, 3, 4, 5, 6] and spark.table("numbered").where("received_at is null").count() == 0
    finally:
        sys.path.remove(str(folder))
        os.environ["PYTHONPATH"] = old


def test_listing_pages():
    names = [f"data/A/A-1m-2025-{m:02d}.zip" for m in range(1, 8)]

    def fetch(prefix, marker):
        left = [n for n in names if n > marker]
        items = "".join(f"<Contents><Key>{n}</Key></Contents>" for n in left[:3])
        folders = "<CommonPrefixes><Prefix>data/A/</Prefix></CommonPrefixes>" if not marker else ""
        return f'<ListBucketResult xmlns="http://x/"><IsTruncated>{"true" if len(left) > 3 else "false"}</IsTruncated>{items}{folders}</ListBucketResult>'

    got = list(archives.listing(fetch, "data/"))
    assert [n for k, n in got if k == "key"] == names and [n for k, n in got if k == "prefix"] == ["data/A/"]


def row(minute, volume=10.0):
    t = START + minute * 60_000
    return [t, 1, 2, 1, 1.5, volume, t + 59_999, 15, 3, 5, 7, 0]


def zipped(rows) -> bytes:
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("x.csv", "\n".join(",".join(map(str, r)) for r in rows))
    return b.getvalue()


def test_cascade(spark, tmp_path):
    """December by month, the first of January by day, then the tail; a damaged archive is reported, gaps are repaired and filled."""
    spot, other = dataset("binance_spot_1m"), dataset("crypto_1m")
    store = {
        "m/AAA-1m-2024-12.zip": zipped([row(m) for m in range(-120, 0)]), "d/AAA-1m-2025-01-01.zip": zipped([row(m) for m in [*range(0, 60), *range(70, 100)]]),
        "d/AAA-1m-2024-12-31.zip": b"never asked for", "d/AAA-1m-2025-01-02.zip": b"damaged", "m/AAA-1m-2020-01.zip": b"too old",
    }

    def listing(prefix, marker):
        keys = "".join(f"<Contents><Key>{k}</Key></Contents>" for k in sorted(store) if k.startswith(prefix))
        return f"<L><IsTruncated>false</IsTruncated>{keys}</L>"

    def download(key):
        return store[key]

    def fetch(symbol, start, end, limit):
        return [row(m) for m in range(-120, 160) if START + m * 60_000 >= start and START + m * 60_000 <= end and not 60 <= m < 65][:limit]

    sinks.upsert(spark.createDataFrame([(T0 + timedelta(minutes=m), "AAA", 1.0, 2.0, 1.0, 1.5, 5.0) for m in range(0, 100)], "time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double"), f"{tmp_path}/{other.path}", ["symbol", "time"])
    args = (spark, str(tmp_path), spot, listing, download, ["m/"], ["d/"], fetch, "x", "now", datetime(2024, 12, 31, 22), T0 + timedelta(minutes=150, seconds=20), spark.createDataFrame([("AAA",)], "symbol string"), other)
    state = sinks.State(spark, str(tmp_path / "state.json"))
    done = pipelines.cascade(*args, state=state)
    assert done["monthly"]["archives"] == 1 and done["monthly"]["rows_written"] == 120
    assert done["daily"]["archives"] == 1 and done["daily"]["rows_written"] == 90, done["daily"]
    assert done["repair"] == {"gaps": 1, "missing": 10, "rows_written": 5} or done["audit"]["info"]["gaps"] == 0
    assert done["audit"]["info"]["gaps"] == 0 and done["audit"]["row_count"] == 120 + 150
    assert state.read()[spot.name]["gaps"] == 0 and state.read()[spot.name]["latest_time"] == "2025-01-01 02:29:00"
    again = pipelines.cascade(*args)
    assert again["monthly"]["archives"] == again["daily"]["archives"] == 0 and again["audit"]["row_count"] == 270
    later = list(args)
    later[11] = datetime(2025, 1, 3)
    assert pipelines.cascade(*later)["daily"]["rejects"][0][0] == "d/AAA-1m-2025-01-02.zip"


def test_small_gaps_from_archives_then_by_fetching(spark, tmp_path):
    ds = dataset("crypto_binance_quarterly_1m")
    kind = "time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double"
    held = [m for m in range(0, 200) if m not in (10, 11, 50) and not 100 <= m < 160]
    sinks.upsert(spark.createDataFrame([(T0 + timedelta(minutes=m), "AAA", 1.0, 2.0, 1.0, 1.5, 5.0) for m in held], kind), f"{tmp_path}/{ds.path}", ["symbol", "time"])
    asked = []

    def download(key):
        if key != "d/AAA-1m-2025-01-01.zip":
            raise OSError("no such key")
        return zipped([row(m) for m in range(0, 12)])

    def fetch(symbol, start, end, limit):
        return [row(m) for m in range(0, 200) if start <= START + m * 60_000 <= end][:limit]

    key = lambda symbol, day: F.format_string("d/%s-1m-%s.zip", symbol, F.date_format(day, "yyyy-MM-dd"))
    done = pipelines.repair_small_gaps(spark, str(tmp_path), ds, key, download, fetch, "x", "now", 600)
    assert done == {"gaps": 2, "archives": 1, "from_archives": 12, "rejected": 0, "repair": {"gaps": 1, "missing": 1, "rows_written": 1}} and not asked
    assert lake.scan(spark, str(tmp_path), ds).count() == 140
    assert sorted(r.time.minute for r in lake.times(lake.scan(spark, str(tmp_path), ds).withColumnRenamed("time", "open_time")).where("minute(time) in (10, 50)").collect()) == [10, 10, 10, 50, 50]
    with pytest.raises(ValueError):
        lake.times(spark.createDataFrame([("A",)], "symbol string"))


def test_tail_of_dated_contracts(spark):
    todo = spark.createDataFrame([(s, T0) for s in ("A_250329", "B", "C", "D_250101")], "symbol string, fetch_from timestamp_ntz")
    symbols = spark.createDataFrame([("A_250329", None), ("B", datetime(2025, 2, 1)), ("C", None), ("D_250101", None)], "symbol string, delivery_time timestamp_ntz")
    got = {r.symbol: r.to for r in pipelines.clipped(todo, symbols, datetime(2025, 6, 1), 60).collect()}
    assert got == {"A_250329": datetime(2025, 3, 28, 23, 59), "B": datetime(2025, 1, 31, 23, 59), "C": datetime(2025, 6, 1)}


def test_matrix_updates(spark, tmp_path):
    ds = dataset("binance_daily_matrix")
    day = lambda y, d, s, c: (datetime(y, 1, d), s, c, c, c, c, 1.0)
    kind = "time timestamp_ntz, symbol string, open double, high double, low double, close double, volume double"
    pipelines.update_matrix(spark, str(tmp_path), ds, spark.createDataFrame([day(2024, 1, "A", 1.0), day(2025, 1, "A", 2.0), day(2025, 1, "B", 3.0)], kind))
    held = {f: f.stat().st_mtime_ns for f in (tmp_path / ds.path / "year=2024").rglob("*.parquet")}
    new = spark.createDataFrame([day(2025, 2, "A", 4.0), (datetime(2025, 1, 1), "B", None, None, None, 9.0, None)], kind)
    assert pipelines.update_matrix(spark, str(tmp_path), ds, new)["years"] == [2025]
    rows = {(r.time.year, r.time.day, r.symbol): (r.open, r.close) for r in spark.read.parquet(f"{tmp_path}/{ds.path}").collect()}
    assert rows == {(2024, 1, "A"): (1.0, 1.0), (2025, 1, "A"): (2.0, 2.0), (2025, 1, "B"): (3.0, 9.0), (2025, 2, "A"): (4.0, 4.0)} and all(f.stat().st_mtime_ns == t for f, t in held.items())
    bars = spark.createDataFrame([(datetime(2025, 1, 1, 3), "A", 1.0, 0.5, 2.0, 1.5, 1.0, 1), (datetime(2025, 1, 1, 9), "A", 2.0, 1.0, 3.0, 2.5, 1.0, 2), (datetime(2025, 1, 1), "C", None, 1.0, 1.0, 1.0, 1.0, 3)], f"{kind}, seq long")
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    assert pipelines.rebuild_matrix(spark, str(tmp_path), ds, bars, names, "seq") == {"missing_symbols": ["B", "C"]}
    assert [(r.symbol, r.high, r.low, r.close) for r in spark.read.parquet(f"{tmp_path}/{ds.path}").collect()] == [("A", 3.0, 1.0, 2.5)]
    wide = matrix.pivot(spark.read.parquet(f"{tmp_path}/{ds.path}"), ["A", "Z"], "close")
    matrix.write_wide(wide, str(tmp_path / "csv"))
    assert [p.read_text() for p in (tmp_path / "csv").glob("*.csv")] == ["date,A,Z\n2025-01-01,2.5,\"\"\n"] or spark.read.csv(str(tmp_path / "csv"), header=True).first()[0] == "2025-01-01"


def test_seeding(spark, tmp_path):
    old = spark.createDataFrame([("2025-01-01 00:00:00", "A", "1", "2", "1", "1.5", "7", "1735689659999", "3.0"), ("2025-01-01 00:01:00", "A", "1", "2", "1", "x", "7", "2025-01-01 00:01:59.999", "3"), ("?", "A", *"11111", None, None)],
                                "open_time string, symbol string, open string, high string, low string, close string, volume string, close_time string, count string")
    ds = dataset("crypto_1m")
    assert seed.seed(spark, old, str(tmp_path), ds, "kline", "old", "now", dry_run=True)["rows"] == 1 and not (tmp_path / ds.path).exists()
    assert seed.seed(spark, old, str(tmp_path), ds, "kline", "old", "now")["rows_written"] == 1
    (r,) = lake.scan(spark, str(tmp_path), ds).collect()
    assert (r.time, r.close, r.close_time, r.number_of_trades, r.quote_volume, r.source) == (T0, 1.5, datetime(2025, 1, 1, 0, 0, 59, 999000), 3, None, "old")
    assert seed.base_candles(old.withColumnRenamed("open_time", "time"), "s", "now").count() == 1
    o = seed.option_snapshots(spark.createDataFrame([("BTC-250101-1-C", "2025-01-01 00:00:00"), ("ETH-250101-1-C", "never")], "symbol string, time string"), "s", "now").collect()
    assert [(x.underlying, x.snapshot_time, x.source) for x in o] == [("BTC", T0, "s")]


def test_replies(spark):
    asked = spark.createDataFrame([("AAA",), ("bad",)], "symbol string")

    def fetch(r):
        if r["symbol"] == "bad":
            raise OSError("refused")
        return json.dumps({"bids": [["99", "2"], ["98", "3"]], "asks": [["101", "4"]]})

    got = rest.replies(asked, fetch, 2)
    assert {r.symbol: r.error for r in got.collect()} == {"AAA": None, "bad": "OSError: refused"}
    book = orderbook.bands_from_levels(rest.depth_levels(got.where("error is null")), [0.01], 0.01).first()
    assert (book.mid_price, book.bid_depth_1pct, book.bid_notional_1pct) == (100.0, 2.0, 198.0)
    empty = spark.createDataFrame([('{"bids": [], "asks": [["1", "1"]]}',), ("broken",), (None,)], "payload string")
    assert rest.depth_levels(empty).count() == 0 and rest.option_marks(empty).count() == 0 and rest.contracts(empty, ["BTCUSDT"]).count() == 0
    marks = spark.createDataFrame([('[{"symbol": "BTC-250101-1-C", "markPrice": "1.5", "delta": "x"}]',)], "payload string")
    assert [(r.symbol, r.markPrice, r.delta) for r in rest.option_marks(marks).collect()] == [("BTC-250101-1-C", 1.5, None)]
    one = {"symbol": "btcusdt_250328", "pair": "BTCUSDT", "contractType": "CURRENT_QUARTER", "status": "TRADING", "quoteAsset": "USDT", "marginAsset": "USDT", "onboardDate": START, "deliveryDate": START + 86_400_000}
    info = spark.createDataFrame([(json.dumps({"symbols": [one, one | {"contractType": "PERPETUAL"}, one | {"pair": "ETHUSDT"}, one | {"quoteAsset": "USD"}]}),)], "payload string")
    assert [tuple(r) for r in rest.contracts(info, ["btcusdt"]).collect()] == [("BTCUSDT_250328", "BTCUSDT", "CURRENT_QUARTER", "TRADING", T0, T0 + timedelta(days=1))]
    waits, calls = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert rest.retrying(flaky, sleep=waits.append)("a") == "a" and waits == [1.0, 2.0]


def test_vendor_bars(spark):
    rows = [("A", '{"data": [{"t": 1735689600, "o": 1, "h": 2, "l": 1, "c": 1.5, "v": null}, {"time": "2025-01-02 00:00:00", "open": "1", "high": "2", "low": "1", "close": "1", "volume": -1}, {"t": 5, "o": "x"}]}'), ("B", '{"ohlc": []}'), ("C", "broken")]
    bars = clean.ohlc_rows(spark.createDataFrame(rows, "symbol string, payload string"), "payload")
    assert [(r.symbol, r.time) for r in bars.where("open is not null").orderBy("time").collect()] == [("A", T0), ("A", datetime(2025, 1, 2))]
    assert [(r.time, r.volume) for r in clean.vendor_bars(bars, "Asia/Ho_Chi_Minh").collect()] == [(datetime(2025, 1, 1, 7), 0)]
    reply = '{"values": [{"datetime": "2025-01-01", "open": "1", "close": "1", "volume": "5"}, {"datetime": "2025-01-02", "close": "2"}, {"datetime": "2025-01-01", "close": "3"}, {"datetime": null}]}'
    got = clean.daily_batch(spark.createDataFrame([("A", reply), ("B", "{}")], "symbol string, payload string")).orderBy("time").collect()
    assert [(r.time, r.close, r.is_closed) for r in got] == [(T0, 3.0, True), (datetime(2025, 1, 2), 2.0, True)]


def test_sessions_to_come(spark):
    off = calendar.holidays(spark, ["2026-06-03"])
    nows = {datetime(2026, 6, 1, 8, 59, 58): datetime(2026, 6, 1, 9), datetime(2026, 6, 1, 11, 30): datetime(2026, 6, 1, 13), datetime(2026, 6, 1, 11, 28, 30): datetime(2026, 6, 1, 11, 29), datetime(2026, 6, 2, 15): datetime(2026, 6, 4, 9), datetime(2026, 6, 5, 14, 45): datetime(2026, 6, 8, 9)}
    df = spark.createDataFrame([(n,) for n in nows], "now timestamp_ntz")
    got = {r.now: r for r in calendar.wait_for_session(spark, df, off).collect()}
    assert {n: r.next_session for n, r in got.items()} == nows
    assert got[datetime(2026, 6, 1, 8, 59, 58)].wait_s == 7 and got[datetime(2026, 6, 1, 11, 28, 30)].wait_s == 35
    shut = calendar.holidays(spark, [str(date(2026, 6, 1) + timedelta(days=i)) for i in range(20)])
    assert [(r.next_session, r.wait_s) for r in calendar.wait_for_session(spark, df.limit(1), shut).collect()] == [(None, 3600)]
    minutes = calendar.session_minutes(spark, "2026-06-05", 4, off)
    assert minutes.count() == 2 * (151 + 106) and calendar.next_session(minutes, "time", F.lit("2026-06-05 14:45:00").cast("timestamp_ntz")).first()[0] == datetime(2026, 6, 8, 9)


def test_audits(spark):
    df = spark.createDataFrame([("A", T0 + timedelta(hours=h), 1.0) for h in (2, 3, 6, 6)] + [("B", T0, -1.0)], "symbol string, time timestamp_ntz, bid_depth_1pct double")
    a, b = validate.audit(df, 3600, expected_start=T0).orderBy("symbol").collect()
    assert (a.rows, a.n_times, a.duplicates, a.n_gaps, a.max_gap_minutes, a.gap_minutes) == (4, 3, 1, 2, 179, 120 + 179) and b.n_gaps == 0
    assert [r.n_gaps for r in validate.audit(df, 3600, since=T0 + timedelta(hours=3)).collect()] == [1]
    r = validate.report(df, "orderbook_snapshot_1h")
    assert r["info"]["gaps"] == 1 and r["info"]["examples"] == [{"symbol": "A", "prev": "2025-01-01 03:00:00", "next": "2025-01-01 06:00:00", "missing": "2"}]


def test_resume_from_several_sources(spark):
    names = spark.createDataFrame([("A",), ("B",)], "symbol string")
    known = lambda *rows: spark.createDataFrame(list(rows), "symbol string, latest_time timestamp_ntz")
    got = {r.symbol: r.fetch_from for r in gaps.resume_latest(names, [known(("A", T0)), known(("A", T0 + timedelta(hours=1)), ("A", None)), known()], T0 - timedelta(days=9), 600).collect()}
    assert got == {"A": T0 + timedelta(minutes=50), "B": T0 - timedelta(days=9)}


def test_jobs(spark, tmp_path):
    beats = sinks.Heartbeat(spark, str(tmp_path))
    beats.beat("a", at=T0)
    beats.beat("b", "error", at=T0, rows=1)
    assert beats.health({"a": 60, "b": 60, "c": 60}, T0 + timedelta(seconds=30)) == {"a": "ok", "b": "failed", "c": "missing"}
    assert beats.health({"a": 60}, T0 + timedelta(seconds=90)) == {"a": "stale"}
    with sinks.single_writer(spark, str(tmp_path / "lock")):
        with pytest.raises(BlockingIOError):
            with sinks.single_writer(spark, str(tmp_path / "lock")):
                pass
    with sinks.single_writer(spark, str(tmp_path / "lock")):
        pass


def test_cleansing_in_place(spark, tmp_path):
    path = str(tmp_path / "lake")
    kind = "time timestamp_ntz, symbol string, v int"
    rows = [(datetime(2026, 6, 1, 9), "A", 1), (datetime(2026, 6, 1, 9), "A", 2), (datetime(2026, 6, 1, 12), "A", 3), (datetime(2026, 7, 1, 9), "A", 4), (datetime(2026, 8, 1, 9), "A", 5)]
    spark.createDataFrame(rows, kind).withColumns({"year": F.year("time"), "month": F.month("time")}).write.partitionBy("symbol", "year", "month").parquet(path)
    assert sinks.cleanse(spark, path, "v", calendar.holidays(spark, []), calendar.STOCK_SESSIONS) == {"touched": 2, "removed": 3}
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 4]


def test_small_scalars(spark):
    df = spark.createDataFrame([(1.005, "BTCUSDT_250328"), (2.675, "btcusdt_250328"), (None, "BTCUSDT"), (0.125, "ETHUSDT_250328")], "p double, s string")
    got = df.select(market.stream_price(F.col("p")).alias("p"), market.dated_contract(F.col("s"), ["BTCUSDT"]).alias("d")).collect()
    assert [r.p for r in got][2:] == [0.0, 0.12] and [r.d for r in got] == [True, True, False, False]
    t = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in (0, 60, 120, 150)], "time timestamp_ntz")
    assert [r.time for r in clean.closed(t, "time", T0 + timedelta(seconds=179), 60).orderBy("time").collect()] == [T0, T0 + timedelta(seconds=60)]
    # The first case of RFC 4231.
    assert signing.hexdigest("\x0b" * 20, "Hi There") == "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"
    assert "%" in signing.signature("k", {"a": "1", "b": "2"}) or signing.signature("k", {"a": "1", "b": "2"}).isalnum()
