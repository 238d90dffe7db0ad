"""Further queries of the engine's own operators: sinks, audits, connectors' payloads, sessions, matrices; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide import validate
from bartide.functions import calendar, market
from bartide.operators import clean, gaps, matrix, orderbook
from bartide.plans import pipelines
from bartide.plans.reference import _BOOK, _DAILY, _GOOD, _IN, _MARKS, _TICKS, SYMBOLS, _daily, _option_marks, good, r6, ticks
from bartide.registry import Dataset
from bartide.session import work_path
from bartide.sources import archives, lake, rest, seed, sinks
from bartide.sources.tables import table
from bartide.streaming import events as stream_events

QUERIES: dict = {}
SQL: dict[str, str] = {}
OHLCV = ("open", "high", "low", "close", "volume")
START = "2025-10-14"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# Order, continuity, audits.


@query("select symbol, time, max(number_of_trades) as number_of_trades, count(*) > 0 as kept from candle group by symbol, time")
def keep_last_null_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without an order stay where their key has no other: no key is lost."""
    kept = clean.keep_last(table(spark, sf, "candle"), ["symbol", "time"], "number_of_trades")
    return kept.select("symbol", "time", "number_of_trades", F.lit(True).alias("kept"))


@query(f"""with {_GOOD}, t as (select distinct symbol, time from good), s as (select symbol, lag(time) over (partition by symbol order by time) as prev, time as next from t),
  f as (select symbol, min(time) as next from t group by symbol)
  select symbol, prev, next, date_diff('microsecond', prev, next) // 60000000 - 1 as gap_minutes from s where date_diff('microsecond', prev, next) >= 301000000
  union all select symbol, timestamp '{START}', next, date_diff('microsecond', timestamp '{START}', next) // 60000000 from f where next > timestamp '{START}'""")
def head_gaps(spark, sf):
    return gaps.with_head(good(spark, sf), 300, START, floor_s=None)


@query(f"""with {_GOOD}, t as (select symbol, time, count(*) as n, sum((high < greatest(open, close, low) or low > least(open, close, high))::int) as bad,
    sum((least(open, high, low, close) < 0 or volume < 0)::int) as neg from good group by 1, 2),
  s as (select symbol, date_diff('microsecond', lag(time) over (partition by symbol order by time), time) as d from t),
  g as (select symbol, d // 60000000 - 1 as m from s where d >= 301000000 union all select symbol, date_diff('microsecond', timestamp '{START}', min(time)) // 60000000 from t group by symbol having min(time) > timestamp '{START}'),
  h as (select symbol, count(*) as n_gaps, max(m) as max_gap_minutes, sum(m)::bigint as gap_minutes from g group by symbol)
  select symbol, sum(n)::bigint as rows, count(*) as n_times, min(time) as min_time, max(time) as max_time, sum(n - 1)::bigint as duplicates, coalesce(sum(bad), 0)::bigint as ohlc_bad, coalesce(sum(neg), 0)::bigint as negative,
    coalesce(any_value(n_gaps), 0) as n_gaps, coalesce(any_value(max_gap_minutes), 0) as max_gap_minutes, coalesce(any_value(gap_minutes), 0)::bigint as gap_minutes from t left join h using (symbol) group by symbol""")
def spot_audit(spark, sf):
    return validate.audit(good(spark, sf), 300, START)


@query(f"""with {_TICKS}, h as (select symbol, date_trunc('hour', time) as time from ticks where time >= timestamp '2024-01-20'), t as (select symbol, time, count(*) as n from h group by 1, 2),
  s as (select symbol, date_diff('second', lag(time) over (partition by symbol order by time), time) as d from t), g as (select symbol, count(*) as c, max(d // 60 - 1) as m, sum(d // 60 - 1) as a from s where d > 3600 group by symbol)
  select symbol, sum(n)::bigint as rows, count(*) as n_times, min(time) as min_time, max(time) as max_time, sum(n - 1)::bigint as duplicates, coalesce(any_value(c), 0) as n_gaps,
    coalesce(any_value(m), 0) as max_gap_minutes, coalesce(any_value(a), 0)::bigint as gap_minutes from t left join g using (symbol) group by symbol""")
def orderbook_audit(spark, sf):
    """Hourly snapshots within a lookback."""
    hours = ticks(spark, sf).select("symbol", market.floor_time(F.col("time"), 3600).alias("time"))
    return validate.audit(hours, 3600, since="2024-01-20")


@query(f"""with {_GOOD}, t as (select distinct symbol, time from good), s as (select symbol, lag(time) over (partition by symbol order by time) as prev, time as next from t),
  g as (select symbol, min(prev) as prev, arg_min(next, prev) as next from s where date_diff('microsecond', prev, next) >= 301000000 group by symbol)
  select symbol, prev, next, prev + interval 300 second as missing_start, next - interval 300 second as missing_end, (date_diff('microsecond', prev, next) // 1000000 + 299) // 300 - 1 as missing,
    date_diff('microsecond', prev, next) // 1000000 as seconds from g order by symbol limit 5""")
def gap_examples(spark, sf):
    return validate.example_gaps(gaps.ranges(good(spark, sf), 300, floor_s=None))


@query(f"""with k as (select symbol, time from candle union all select symbol, time from candle_batch), l as (select symbol, max(time) as latest_time from k group by symbol)
  select i.symbol, latest_time, coalesce(latest_time - interval 600 second, timestamp '{START}') as fetch_from from (select distinct symbol from instrument) i left join l using (symbol)""")
def resume_sources(spark, sf):
    """Where to go on from, by the latest of what several places know."""
    known = [lake.extent(table(spark, sf, n)) for n in ("candle", "candle_batch")]
    return gaps.resume_latest(table(spark, sf, "instrument"), known, START, 600)


@query("select bar_id, symbol, time from candle where time <= timestamp '2025-11-01 12:25:00'")
def closed_bars(spark, sf):
    return clean.closed(table(spark, sf, "candle"), "time", "2025-11-01 12:34:56", 300).select("bar_id", "symbol", "time")


# Sinks.


@query(f"""with {_GOOD}, f as (select *, date_trunc('minute', time) as minute from good), k as (select symbol, minute, arg_max(struct_pack(o := open, h := high, l := low, c := close, b := bar_id), bar_id) as r from f group by 1, 2)
  select symbol, minute as time, r.b as bar_id, r.o as open, case when r.o is null or r.h is null or r.l is null or r.c is null then null else greatest(r.o, r.h, r.l, r.c) end as high,
    case when r.o is null or r.h is null or r.l is null or r.c is null then null else least(r.o, r.h, r.l, r.c) end as low, r.c as close from k""")
def normalised_in_place(spark, sf):
    path = work_path(spark, "normalised")
    parted = good(spark, sf).withColumns({"year": F.year("time"), "month": F.month("time")})
    parted.write.partitionBy("symbol", "year", "month").parquet(path)
    sinks.normalise(spark, path, "bar_id")
    return spark.read.parquet(path).select("symbol", "time", "bar_id", *clean.PRICES)


@query(f"with {_GOOD} select symbol, time, min(bar_id) as bar_id from good where {_IN} and time::date <> date '2025-11-03' group by symbol, time")
def cleansed_in_place(spark, sf):
    path = work_path(spark, "cleansed")
    good(spark, sf).withColumns({"year": F.year("time"), "month": F.month("time")}).write.partitionBy("symbol", "year", "month").parquet(path)
    sinks.cleanse(spark, path, "bar_id", calendar.holidays(spark, ["2025-11-03"]), calendar.STOCK_SESSIONS)
    return spark.read.parquet(path).select("symbol", "time", "bar_id")


@query(f"with {_GOOD} select symbol, time, max(bar_id) as bar_id from good group by symbol, time")
def upsert_by_month(spark, sf):
    """Two batches into folders by symbol and month, in order of arrival."""
    path, df = work_path(spark, "by-month"), good(spark, sf)
    sinks.upsert(df.where("time < timestamp_ntz '2025-11-01'"), path, ["symbol", "time"], order="bar_id")
    sinks.upsert(df.where("time >= timestamp_ntz '2025-10-25'"), path, ["symbol", "time"], order="bar_id")
    return spark.read.parquet(path).select("symbol", "time", "bar_id")


@query(f"""with {_MARKS} select underlying, count(*) as n, min(strike) as least_strike, max(expiry) as last_expiry from m where underlying <> '' group by underlying""")
def upsert_by_underlying(spark, sf):
    """Option rows in folders by underlying."""
    from bartide.operators import options

    path = work_path(spark, "by-underlying")
    rows = options.parsed(_option_marks(spark, sf)).withColumn("snapshot_time", F.col("expiry").cast("timestamp_ntz"))
    sinks.upsert(rows, path, ["o_orderkey"], "snapshot_time", "underlying", "year")
    got = spark.read.parquet(path)
    return got.groupBy("underlying").agg(F.count("*").alias("n"), F.min("strike").alias("least_strike"), F.max("expiry").alias("last_expiry"))


@query(f"with {_TICKS} select symbol, time, max(seq) as seq from ticks group by symbol, time")
def streaming_upsert(spark, sf):
    path = work_path(spark, "stream-lake")
    stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    rows = stream.select(F.col("event_id").alias("seq"), F.col("ts").alias("time"), F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    stream_events.run_available(rows, work_path(spark, "stream-lake-checkpoint"), batch=stream_events.upsert_to(path, ["symbol", "time"], order="seq"))
    return spark.read.parquet(path).select("symbol", "time", "seq")


_DAY_KEYS = f"with {_GOOD}, d as (select distinct symbol, time::date as day from good)"


@query(f"""with {_TICKS}, l as (select symbol, max(time) as latest_time from ticks group by symbol) select symbol, latest_time from l""")
def lake_latest(spark, sf):
    root, ds = work_path(spark, "latest"), Dataset("t", "t")
    ticks(spark, sf).withColumns({"year": F.year("time"), "month": F.month("time")}).write.partitionBy("symbol", "year", "month").parquet(f"{root}/t")
    return lake.latest(spark, root, ds)


@query(f"with {_GOOD} select distinct upper(symbol) as symbol from good")
def lake_symbols(spark, sf):
    root, ds = work_path(spark, "discover"), Dataset("t", "t")
    good(spark, sf).write.partitionBy("symbol").parquet(f"{root}/t")
    return lake.discover(spark, root, ds)


# Files and payloads.


@query(f"""with {_GOOD} select bar_id, symbol, time, open, close, case when symbol < 'N' then volume end as volume from good""")
def csv_by_header(spark, sf):
    """Files whose headers differ in order, names and columns."""
    path, df = work_path(spark, "csv"), good(spark, sf)
    df.where("symbol < 'N'").select("time", "symbol", "bar_id", "open", F.col("volume").alias("vol"), "close").write.option("header", "true").csv(f"{path}/a", compression="gzip")
    df.where("symbol >= 'N'").select("close", "bar_id", "open", "time", "symbol", "source").write.option("header", "true").csv(f"{path}/b")
    columns = {"bar_id": "bigint", "symbol": "string", "time": "timestamp_ntz", "open": "double", "close": "double", "volume": "double"}
    return lake.csv_by_header(spark, path, columns, {"vol": "volume"})[0]


@query(f"{_DAILY} select symbol, time::date as time, round(close, 6) as close from d where symbol in ({', '.join(repr(s) for s in SYMBOLS)}) and close is not null")
def wide_csv_roundtrip(spark, sf):
    path = work_path(spark, "wide")
    matrix.write_wide(matrix.pivot(_daily(spark, sf), SYMBOLS, "close"), path)
    return lake.wide_csv(spark, path, "close").select("symbol", "time", r6("close", "close"))


@query(f"""{_DAY_KEYS}, k as (select 'd/' || symbol || '-1m-' || strftime(day, '%Y-%m-%d') || '.zip' as key, symbol, day as date from d
    union all select distinct 'm/' || symbol || '-1m-' || strftime(day, '%Y-%m') || '.zip', symbol, date_trunc('month', day)::date from d)
  select key, symbol, date from k where (date >= date '2025-10-20' or (key like 'm/%' and date >= date '2025-10-01')) and date <= date '2025-11-10'
    and not exists (select 1 from candle_batch b where b.symbol = k.symbol and b.time::date = k.date)""")
def archive_keys_wanted(spark, sf):
    days = good(spark, sf).select("symbol", F.col("time").cast("date").alias("day")).distinct()
    daily = days.select(F.format_string("d/%s-1m-%s.zip", "symbol", F.date_format("day", "yyyy-MM-dd")).alias("key"))
    monthly = days.select(F.format_string("m/%s-1m-%s.zip", "symbol", F.date_format("day", "yyyy-MM")).alias("key")).distinct()
    stored = table(spark, sf, "candle_batch").select("symbol", F.col("time").cast("date").alias("date"))
    return archives.wanted_keys(daily.unionByName(monthly), "key", "2025-10-20", "2025-11-10", stored).select("key", "symbol", "date")


def _bars_by_day(spark, sf) -> DataFrame:
    """Bars of a day as an array, by symbol and day."""
    one = F.struct(F.unix_seconds(F.col("time").cast("timestamp")).alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"), "bar_id")
    return good(spark, sf).groupBy("symbol", F.col("time").cast("date").alias("day")).agg(F.array_sort(F.collect_list(one)).alias("bars"))


_SECONDS = f"with {_GOOD} select symbol, date_trunc('second', time) as time, open, high, low, close, volume from good"


@query(_SECONDS)
def json_parallel_arrays(spark, sf):
    part = lambda k: F.transform("bars", lambda b: b[k]).alias(k)
    replies = _bars_by_day(spark, sf).select("symbol", F.to_json(F.struct(*[part(k) for k in "tohlcv"]), {"ignoreNullFields": "false"}).alias("payload"))
    return clean.ohlc_columns(replies, "payload").select("symbol", "time", *OHLCV)


@query(_SECONDS)
def json_rows(spark, sf):
    replies = _bars_by_day(spark, sf).select("symbol", F.to_json(F.struct(F.col("bars").alias("data"))).alias("payload"))
    return clean.ohlc_rows(replies, "payload").select("symbol", "time", *OHLCV)


@query(f"""with {_GOOD}, k as (select *, (time + interval 7 hour) as local from (select symbol, date_trunc('second', time) as time, open, high, low, close, volume from good))
  select symbol, local as time, open, high, low, close, trunc(coalesce(volume, 0))::bigint as volume from k where open is not null and high is not null and low is not null and close is not null and trunc(coalesce(volume, 0)) >= 0""")
def vendor_bars(spark, sf):
    replies = _bars_by_day(spark, sf).select("symbol", F.to_json(F.struct(F.col("bars").alias("candles"))).alias("payload"))
    return clean.vendor_bars(clean.ohlc_rows(replies, "payload"), "Asia/Ho_Chi_Minh").select("symbol", "time", *OHLCV)


@query(f"with {_TICKS} select symbol, date_trunc('day', time) as time, arg_max(round(price, 6), seq) as close, true as is_closed from ticks where price is not null group by 1, 2")
def daily_batch(spark, sf):
    """Replies with several rows a day, of which the last stays."""
    t = ticks(spark, sf).where("price is not null").withColumn("day", F.col("time").cast("date"))
    one = F.struct("seq", F.col("day").cast("string").alias("datetime"), F.round("price", 6).alias("close"))
    replies = t.groupBy("symbol", "day").agg(F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("values"))).alias("payload"))
    return clean.daily_batch(replies.select("symbol", "payload")).select("symbol", "time", "close", "is_closed")


@query(f"""{_BOOK}, d as (select vec_id, list_sum(list_transform(list_filter(bids, lambda x: x.price >= 100 * 0.99), lambda x: x.qty)) as b1, list_sum(list_transform(list_filter(asks, lambda x: x.price <= 100 * 1.05), lambda x: x.qty * x.price)) as n5 from b)
  select vec_id, 100.0::double as mid_price, round(b1, 6) as bid_depth_1pct, round(n5, 6) as ask_notional_5pct from d""")
def depth_replies(spark, sf):
    side = lambda sign, off: F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.array((100 + sign * i.cast("double") / 4).cast("string"), F.abs(F.element_at("embedding", i + off).cast("double")).cast("string")))
    replies = table(spark, sf, "embeddings").select("vec_id", F.to_json(F.struct(side(-1, 0).alias("bids"), side(1, 32).alias("asks"))).alias("payload"))
    out = orderbook.bands_from_levels(rest.depth_levels(replies), [0.01, 0.05], 0.01)
    return out.select("vec_id", "mid_price", r6("bid_depth_1pct", "bid_depth_1pct"), r6("ask_notional_5pct", "ask_notional_5pct"))


@query(f"""with {_MARKS} select o_orderkey, symbol, round(price, 6) as "lastPrice" from m""")
def option_replies(spark, sf):
    """A reply per day with all marks of that day."""
    marks = _option_marks(spark, sf)
    replies = marks.select("o_orderkey", F.to_json(F.array(F.struct("symbol", F.col("price").cast("string").alias("lastPrice")))).alias("payload"))
    return rest.option_marks(replies).select("o_orderkey", "symbol", r6("lastPrice", "lastPrice"))


_CONTRACT = "o_orderstatus || 'USDT_' || strftime(o_orderdate, '%y%m%d')"


@query(f"""select o_orderkey, {_CONTRACT} as symbol, o_orderstatus || 'USDT' as pair, o_orderdate::timestamp as delivery_time from orders where o_orderstatus in ('F', 'O')""")
def contract_discovery(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("timestamp_ntz"))
    ms = F.unix_millis(F.col("d").cast("timestamp"))
    one = F.struct(F.concat("o_orderstatus", F.lit("usdt_"), F.date_format("d", "yyMMdd")).alias("symbol"), F.concat("o_orderstatus", F.lit("USDT")).alias("pair"), F.lit("CURRENT_QUARTER").alias("contractType"),
                   F.lit("USDT").alias("quoteAsset"), F.lit("USDT").alias("marginAsset"), F.col("o_orderkey").alias("onboardDate"), ms.alias("deliveryDate"))
    info = o.select(F.to_json(F.struct(F.array(one, one.withField("contractType", F.lit("PERPETUAL"))).alias("symbols"))).alias("payload"))
    found = rest.contracts(info, ["fusdt", "OUSDT"])
    key = F.unix_millis(F.col("onboard_time").cast("timestamp")).alias("o_orderkey")
    return found.select(key, "symbol", "pair", "delivery_time")


@query(f"""select o_orderkey, {_CONTRACT} as symbol, strptime('20' || strftime(o_orderdate, '%y%m%d'), '%Y%m%d')::date as delivery from orders where o_orderstatus in ('F', 'P')""")
def dated_contracts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.concat("o_orderstatus", F.lit("USDT_"), F.date_format("o_orderdate", "yyMMdd")).alias("symbol"))
    return o.where(market.dated_contract(F.col("symbol"), ["FUSDT", "PUSDT"])).select("o_orderkey", "symbol", market.delivery_date(F.col("symbol")).alias("delivery"))


@query(f"""with c as (select {_CONTRACT} as symbol, max(o_orderdate)::timestamp as d from orders group by 1), e as (select symbol, least(timestamp '2000-01-01', d - interval 60 second) as "to" from c)
  select symbol, timestamp '1995-01-01' as "from", "to" from e where "to" >= timestamp '1995-01-01'""")
def contract_tails(spark, sf):
    """What is left to fetch of each contract, up to the last minute before its delivery."""
    o = table(spark, sf, "orders").select(F.concat("o_orderstatus", F.lit("USDT_"), F.date_format("o_orderdate", "yyMMdd")).alias("symbol"), F.col("o_orderdate").cast("timestamp_ntz").alias("delivery_time"))
    todo = o.select("symbol").distinct().withColumn("fetch_from", F.lit("1995-01-01").cast("timestamp_ntz"))
    return pipelines.clipped(todo, o, "2000-01-01", 60)


# Seeding and matrices.


@query("""select time, symbol, open, high, low, close, volume, close_time, quote_volume, number_of_trades, 'seed' as source from candle
  where time is not null and open is not null and high is not null and low is not null and close is not null and not isnan(close)""")
def seed_klines(spark, sf):
    """Text columns under older names, close_time in milliseconds."""
    old = table(spark, sf, "candle").withColumns({"close_time": F.unix_millis(F.col("close_time").cast("timestamp")), "n": F.col("number_of_trades")})
    names = {"open_time": "time", "count": "n", "quote_asset_volume": "quote_volume"}
    text = old.select("symbol", *[F.col(c).cast("string").alias(c) for c in (*OHLCV, "close_time")], *[F.col(c).cast("string").alias(n) for n, c in names.items()])
    out = seed.kline_candles(text, "seed", "now")
    return out.select("time", "symbol", *OHLCV, "close_time", "quote_volume", "number_of_trades", "source")


@query(f"""with {_MARKS} select m.o_orderkey, m.symbol, split_part(m.symbol, '-', 1) as underlying, o.o_orderdate::timestamp as snapshot_time from m join orders o using (o_orderkey)""")
def seed_options(spark, sf):
    marks = _option_marks(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("time")), "o_orderkey")
    return seed.option_snapshots(marks, "seed", "now").select("o_orderkey", "symbol", "underlying", "snapshot_time")


_HALF = f"""{_DAILY}, old as (select * from d where time < timestamp '2024-01-20'), new as (select symbol, time, open * 2 as open, high * 2 as high, low * 2 as low, null::double as close, volume from d where time >= timestamp '2024-01-10')"""


@query(f"""{_HALF} select symbol, time, round(coalesce(n.open, o.open), 6) as open, round(coalesce(n.high, o.high), 6) as high, round(coalesce(n.low, o.low), 6) as low, round(coalesce(n.close, o.close), 6) as close,
  coalesce(n.volume, o.volume) as volume from new n full join old o using (symbol, time)""")
def matrix_update(spark, sf):
    """An incremental merge: new cells where there are any."""
    root, ds, d = work_path(spark, "matrix"), Dataset("m", "m", kind="matrix"), _daily(spark, sf).drop("n")
    pipelines.update_matrix(spark, root, ds, d.where("time < timestamp_ntz '2024-01-20'"))
    new = d.where("time >= timestamp_ntz '2024-01-10'").withColumns({**{c: F.col(c) * 2 for c in ("open", "high", "low")}, "close": F.lit(None).cast("double")})
    pipelines.update_matrix(spark, root, ds, new)
    return spark.read.parquet(f"{root}/m").select("symbol", "time", *[r6(c, c) for c in clean.PRICES], "volume")


_REBUILT = f"""with {_GOOD}, k as (select symbol, date_trunc('day', time) as time, arg_max(struct_pack(o := open, h := high, l := low, c := close, v := volume), bar_id) as r from good
    where open is not null and high is not null and low is not null and close is not null and symbol in (select symbol from instrument) group by 1, 2)"""


@query(f"{_REBUILT} select symbol, time, r.o as open, greatest(r.o, r.h, r.l, r.c) as high, least(r.o, r.h, r.l, r.c) as low, r.c as close, r.v as volume from k")
def matrix_rebuild(spark, sf):
    root, ds = work_path(spark, "rebuilt"), Dataset("m", "m", kind="matrix")
    pipelines.rebuild_matrix(spark, root, ds, good(spark, sf), table(spark, sf, "instrument"), "bar_id")
    return spark.read.parquet(f"{root}/m").select("symbol", "time", *OHLCV)


@query(f"{_REBUILT} select symbol from instrument where symbol not in (select symbol from k)")
def matrix_missing_symbols(spark, sf):
    return matrix.rebuilt(good(spark, sf), table(spark, sf, "instrument"), "bar_id")[1]


# Sessions.


@query("""with t as (select distinct date_trunc('minute', time) + interval 1 minute as t, time as now from candle_batch where time is not null),
  days as (select unnest(generate_series(date '2025-10-01', date '2025-12-31', interval 1 day)) as day), open_days as (select day::timestamp as day from days where isodow(day) <= 5 and day <> date '2025-11-03'),
  s as (select day + interval 540 minute as a, day + interval 690 minute as b from open_days union all select day + interval 780 minute, day + interval 885 minute from open_days),
  f as (select now, min(greatest(a, t)) as next_session from t join s on b >= t and a <= t + interval 14 day group by now)
  select now, next_session, greatest(date_diff('microsecond', now, next_session + interval 5 second) // 1000000, 5) as wait_s from f""")
def session_waits(spark, sf):
    nows = table(spark, sf, "candle_batch").where("time is not null").select(F.col("time").alias("now")).distinct()
    return calendar.wait_for_session(spark, nows, calendar.holidays(spark, ["2025-11-03"]))


@query("""with days as (select unnest(generate_series(timestamp '2025-10-31', timestamp '2025-11-13', interval 1 day)) as day), m as (select unnest(generate_series(0, 1439)) as m)
  select day + m * interval 1 minute as time from days, m where isodow(day) <= 5 and day <> timestamp '2025-11-03' and (m between 525 and 690 or m between 780 and 885)""")
def session_minutes(spark, sf):
    return calendar.session_minutes(spark, "2025-10-31", 14, calendar.holidays(spark, ["2025-11-03"]), calendar.DERIVATIVE_SESSIONS)


