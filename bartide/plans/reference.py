"""Queries of the engine's own operators over the test tables, each with its SQL.

Views: ticks are ``events`` (ts, event_type, value, the k of props; event_id is the order of arrival); candles are
``candle``; daily bars come from ``lineitem``. Doubles are rounded to 6 places."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide import validate
from bartide.functions import calendar, market
from bartide.operators import clean, gaps, matrix, options, orderbook, symbols
from bartide.session import work_path
from bartide.sources import lake, sinks
from bartide.sources.tables import table
from bartide.streaming import events as stream_events

QUERIES: dict = {}
SQL: dict[str, str] = {}
SYMBOLS = ["click", "error", "purchase", "signup", "view"]

_TICKS = """ticks as (select event_id as seq, ts as time, event_type as symbol, user_id, value as price,
  try_cast(json_extract_string(props, '$.k') as bigint) as volume from events)"""
_GOOD = """good as (select bar_id, time, symbol, open, high, low, case when isnan(close) then null else close end as close, volume, quote_volume, number_of_trades, source
  from candle where time is not null and symbol is not null)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c, name: str):
    return F.round(c, 6).alias(name)


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("ts").alias("time"), F.col("event_type").alias("symbol"), "user_id", F.col("value").alias("price"), k.alias("volume"))


def good(spark: SparkSession, sf: str) -> DataFrame:
    """Candles that have a place: NaN closes as null."""
    df = table(spark, sf, "candle").where("time is not null and symbol is not null")
    return df.select("bar_id", "time", "symbol", "open", "high", "low", market.no_nan(F.col("close")).alias("close"), "volume", "quote_volume", "number_of_trades", "source")


# Continuity.

_STEPS = f"""with {_TICKS}, minutes as (select distinct symbol, date_trunc('minute', time) as t from ticks),
  steps as (select symbol, lag(t) over (partition by symbol order by t) as prev, t as next from minutes),
  d as (select *, date_diff('second', prev, next) as seconds from steps where prev is not null)"""


@query(f"{_STEPS} select symbol, count(*) filter (seconds > 60) as n_gaps, max(seconds) filter (seconds > 60) as max_gap_s from d group by symbol")
def gap_scan(spark, sf):
    return gaps.scan(ticks(spark, sf), 60)


@query(f"""{_STEPS} select symbol, prev, next, prev + interval 60 second as missing_start, next - interval 60 second as missing_end,
  (seconds + 59) // 60 - 1 as missing, seconds from d where seconds > 60""")
def gap_ranges(spark, sf):
    return gaps.ranges(ticks(spark, sf), 60)


@query(f"""{_STEPS} select symbol, prev, next, prev + interval 60 second as missing_start, next - interval 60 second as missing_end,
  (seconds + 59) // 60 - 1 as missing, seconds from d where seconds > 60 and seconds <= 600""")
def small_gap_ranges(spark, sf):
    return gaps.ranges(ticks(spark, sf), 60, 600)


@query(f"""{_STEPS} select symbol, unnest(generate_series(prev + interval 60 second, next - interval 60 second, interval 60 second)) as time
  from d where seconds > 60 and seconds <= 3600""")
def missing_grid(spark, sf):
    return gaps.missing_times(gaps.ranges(ticks(spark, sf), 60, 3600), 60)


@query(f"""with {_GOOD}, t as (select distinct symbol, time from good), s as (select symbol, time, lag(time) over (partition by symbol order by time) as prev from t),
  e as (select symbol, min(time) as first_time, max(time) as latest_time from t group by symbol),
  g as (select symbol, min(prev) as gap from s where date_diff('microsecond', prev, time) >= 301000000 group by symbol),
  b as (select distinct i.symbol from instrument i)
  select b.symbol, first_time, latest_time, greatest(timestamp '2025-10-14', case when first_time is null or first_time > timestamp '2025-10-14 00:05:00' then timestamp '2025-10-14'
    else coalesce(gap, latest_time) - interval 600 second end) as fetch_from from b left join e using (symbol) left join g using (symbol)""")
def resume_start(spark, sf):
    return gaps.resume(good(spark, sf), table(spark, sf, "instrument"), "2025-10-14", 300, 600)


# Cleaning and bars.


@query(f"""with {_TICKS}, r as (select *, row_number() over (partition by symbol, date_trunc('minute', time) order by seq desc) as n from ticks)
  select symbol, date_trunc('minute', time) as minute, seq, round(price, 6) as price, volume from r where n = 1""")
def dedupe_keep_last(spark, sf):
    t = ticks(spark, sf).withColumn("minute", market.floor_time(F.col("time"), 60))
    return clean.keep_last(t, ["symbol", "minute"], "seq").select("symbol", "minute", "seq", r6("price", "price"), "volume")


@query(f"""with {_TICKS}, r as (select *, row_number() over (partition by symbol, date_trunc('minute', time) order by seq) as n from ticks)
  select symbol, date_trunc('minute', time) as minute, seq, round(price, 6) as price, volume from r where n = 1""")
def dedupe_keep_first(spark, sf):
    t = ticks(spark, sf).withColumn("minute", market.floor_time(F.col("time"), 60))
    return clean.keep_first(t, ["symbol", "minute"], "seq").select("symbol", "minute", "seq", r6("price", "price"), "volume")


@query(f"""with {_GOOD}, g as (select *, open is null or high is null or low is null or close is null as bad from good)
  select bar_id, open, case when bad then null else greatest(open, high, low, close) end as high, case when bad then null else least(open, high, low, close) end as low, close from g""")
def bounds_repair(spark, sf):
    return clean.repair_bounds(good(spark, sf)).select("bar_id", "open", "high", "low", "close")


@query(f"""with {_TICKS} select symbol, date_trunc('hour', time) as time, round(arg_min(price, (time, seq)), 6) as open, round(max(price), 6) as high, round(min(price), 6) as low,
  round(arg_max(price, (time, seq)), 6) as close, sum(volume)::bigint as volume, count(*) as n from ticks group by 1, 2""")
def resample_ohlcv_1h(spark, sf):
    b = clean.resample(ticks(spark, sf), "symbol", "time", 3600, "seq", price="price")
    return b.select("symbol", "time", *[r6(c, c) for c in clean.PRICES], "volume", "n")


@query("""select l_suppkey as symbol, date_trunc('day', l_shipdate) as time, round(arg_min(l_extendedprice, (l_shipdate, l_orderkey * 100 + l_linenumber)), 6) as open,
  round(max(l_extendedprice), 6) as high, round(min(l_extendedprice), 6) as low, round(arg_max(l_extendedprice, (l_shipdate, l_orderkey * 100 + l_linenumber)), 6) as close,
  round(sum(l_quantity), 6) as volume, count(*) as n from lineitem group by 1, 2""")
def resample_ohlcv_1d(spark, sf):
    t = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("volume"),
                                            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"))
    b = clean.resample(t, "symbol", "time", 86_400, "seq", price="price")
    return b.select("symbol", "time", *[r6(c, c) for c in clean.PRICES], r6("volume", "volume"), "n")


@query(f"""with {_GOOD}, k as (select * from good where close is not null)
  select symbol, time_bucket(interval 4 hour, time) as time, arg_min(open, (time, bar_id)) as open, max(high) as high, min(low) as low, arg_max(close, (time, bar_id)) as close,
  round(sum(volume), 3) as volume, count(*) as n from k group by 1, 2""")
def resample_candles_4h(spark, sf):
    b = clean.resample(good(spark, sf).where("close is not null"), "symbol", "time", 14_400, "bar_id")
    return b.select("symbol", "time", *clean.PRICES, F.round("volume", 3).alias("volume"), "n")


@query(f"with {_TICKS} select seq, time_bucket(interval 5 minute, time) as bucket from ticks")
def floor_5m(spark, sf):
    return ticks(spark, sf).select("seq", market.floor_time(F.col("time"), 300).alias("bucket"))


@query(f"with {_TICKS} select seq, time + interval 7 hour as local_time from ticks")
def tz_convert_local(spark, sf):
    return ticks(spark, sf).select("seq", F.convert_timezone(F.lit("UTC"), F.lit("Asia/Ho_Chi_Minh"), "time").alias("local_time"))


@query(f"with {_TICKS} select seq, date_trunc('millisecond', time) as from_ms, time as from_us from ticks")
def epoch_unit_detect(spark, sf):
    from bartide.operators.chunks import epoch_us

    t = ticks(spark, sf).withColumn("us", epoch_us("time"))
    return t.select("seq", market.epoch_to_time(F.expr("us div 1000")).alias("from_ms"), market.epoch_to_time(F.col("us")).alias("from_us"))


@query(f"with {_TICKS} select seq, volume, try_cast(price as bigint) as whole from ticks where try_cast(price as bigint) is not null")
def json_extract_props(spark, sf):
    return ticks(spark, sf).select("seq", "volume", F.rint("price").cast("bigint").alias("whole")).where("whole is not null")


# Selection.


@query(f"""with {_TICKS} select symbol, time, seq from ticks where symbol in ('purchase', 'view') and time >= timestamp '2024-01-05' and time <= timestamp '2024-01-20'
  order by symbol, time, seq limit 500""")
def range_filter_symbols_limit(spark, sf):
    t = lake.between(lake.of_symbols(ticks(spark, sf), ["purchase ", "VIEW"]), "time", datetime(2024, 1, 5), datetime(2024, 1, 20))
    return t.orderBy("symbol", "time", "seq").select("symbol", "time", "seq").limit(500)


@query(f"with {_TICKS} select symbol, max(time) as latest_time, min(time) as first_time, count(*) as n from ticks group by symbol")
def latest_per_symbol(spark, sf):
    return lake.extent(ticks(spark, sf))


@query(f"with {_TICKS} select seq, symbol, time from ticks where time >= (select max(date_trunc('hour', time)) from ticks) - interval 10 day")
def retention_prune(spark, sf):
    t, path = ticks(spark, sf), work_path(spark, "retained")
    t.withColumn("day", F.col("time").cast("date")).write.partitionBy("symbol", "day").parquet(path)
    keep_from = t.agg((F.date_trunc("hour", F.max("time")).cast("timestamp_ntz") - F.expr("interval 10 days"))).first()[0]
    sinks.prune(spark, path, keep_from, folders=("symbol", "day"))
    return spark.read.parquet(path).select("seq", "symbol", "time")


_HHMM = "hour(time) * 100 + minute(time)"
_IN = f"isodow(time) <= 5 and ({_HHMM} between 900 and 1130 or {_HHMM} between 1300 and 1445)"
_HOLIDAYS = ", ".join(f"date '{d}'" for d in calendar.VN_HOLIDAYS)


@query(f"with {_TICKS} select seq, symbol, time from ticks where {_IN}")
def trading_hours_filter(spark, sf):
    return ticks(spark, sf).where(calendar.in_session(F.col("time"), calendar.STOCK_SESSIONS)).select("seq", "symbol", "time")


@query(f"with {_GOOD} select bar_id, symbol, time from good where {_IN} and time::date not in ({_HOLIDAYS}, date '2025-10-20', date '2025-11-03')")
def holiday_anti(spark, sf):
    days = calendar.holidays(spark, calendar.VN_HOLIDAYS + ["2025-10-20", "2025-11-03"])
    return calendar.trading_hours(good(spark, sf), "time", days).select("bar_id", "symbol", "time")


@query("""with p as (select symbol, 1 as pr from candle_batch union all select symbol, 2 from candle union all select symbol, 3 from instrument),
  m as (select upper(trim(symbol)) as symbol, min(pr) as priority from p where symbol is not null group by 1)
  select symbol, priority, row_number() over (order by priority, symbol) as position from m""")
def ordered_symbols(spark, sf):
    return symbols.ordered([table(spark, sf, n).select("symbol") for n in ("candle_batch", "candle", "instrument")])


@query("select symbol, market, step_s from instrument where symbol in (select symbol from candle)")
def active_semi(spark, sf):
    return symbols.active(table(spark, sf, "instrument").select("symbol", "market", "step_s"), table(spark, sf, "candle"))


@query("select symbol, market, step_s from instrument i where not exists (select 1 from candle c where c.symbol = i.symbol)")
def inactive_anti(spark, sf):
    return symbols.inactive(table(spark, sf, "instrument").select("symbol", "market", "step_s"), table(spark, sf, "candle"))


@query("select symbol from candle where symbol is not null intersect select symbol from instrument")
def symbols_intersect(spark, sf):
    return symbols.common(table(spark, sf, "candle"), table(spark, sf, "instrument"))


@query("""select bar_id as id, symbol, close, null::int as batch_no, volume from candle
  union all select in_id, symbol, close, batch_no, volume from candle_batch""")
def union_by_name(spark, sf):
    a = table(spark, sf, "candle").select(F.col("bar_id").alias("id"), "symbol", "close", "volume")
    return symbols.united(a, table(spark, sf, "candle_batch").select(F.col("in_id").alias("id"), "batch_no", "volume", "close", "symbol"))


# Merging and matrices.

_HALVES = f"""with {_TICKS}, m as (select symbol, date_trunc('minute', time) as time, seq, price from ticks),
  old as (select symbol, time, arg_max(price, seq) as price from m where time < timestamp '2024-01-20' group by 1, 2),
  new as (select symbol, time, arg_max(price * 2, seq) as price from m where time >= timestamp '2024-01-10' group by 1, 2)"""


def _halves(spark, sf):
    t = ticks(spark, sf).withColumn("time", market.floor_time(F.col("time"), 60)).select("symbol", "time", "seq", "price")
    old = clean.keep_last(t.where("time < timestamp_ntz '2024-01-20'"), ["symbol", "time"], "seq")
    new = clean.keep_last(t.where("time >= timestamp_ntz '2024-01-10'"), ["symbol", "time"], "seq").withColumn("price", F.col("price") * 2)
    return old, new


@query(f"{_HALVES} select coalesce(n.symbol, o.symbol) as symbol, coalesce(n.time, o.time) as time, round(coalesce(n.price, o.price), 6) as price from new n full join old o using (symbol, time)")
def upsert_merge(spark, sf):
    old, new = _halves(spark, sf)
    return matrix.combine_first(new, old, ["price"]).withColumn("price", F.round("price", 6))


_DAILY = f"""with {_TICKS}, d as (select symbol, date_trunc('day', time) as time, arg_min(price, (time, seq)) as open, max(price) as high, min(price) as low, arg_max(price, (time, seq)) as close,
  sum(volume)::bigint as volume from ticks group by 1, 2)"""


def _daily(spark, sf):
    return clean.resample(ticks(spark, sf), "symbol", "time", 86_400, "seq", price="price")


_WIDE = ", ".join(f"round(max(close) filter (symbol = '{s}'), 6) as \"{s}\"" for s in [*SYMBOLS, "unlisted"])


@query(f"{_DAILY} select time, {_WIDE} from d group by time")
def daily_matrix_close(spark, sf):
    wide = matrix.pivot(_daily(spark, sf), [*SYMBOLS, "unlisted"], "close")
    return wide.select("time", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


@query(f"{_DAILY} select symbol, time, round(close, 6) as close from d where symbol in ({', '.join(repr(s) for s in SYMBOLS)}) and close is not null")
def matrix_unpivot(spark, sf):
    return matrix.unpivot(matrix.pivot(_daily(spark, sf), SYMBOLS, "close"), "close").select("symbol", "time", r6("close", "close"))


@query(f"""{_DAILY}, old as (select symbol, time, close from d where time < timestamp '2024-01-20'), new as (select symbol, time, close * 2 as close from d where time >= timestamp '2024-01-10')
  select symbol, time, round(coalesce(n.close, o.close), 6) as close from new n full join old o using (symbol, time)""")
def matrix_combine_first(spark, sf):
    d = _daily(spark, sf)
    new = d.where("time >= timestamp_ntz '2024-01-10'").withColumn("close", F.col("close") * 2)
    return matrix.combine_first(new, d.where("time < timestamp_ntz '2024-01-20'"), ["close"]).select("symbol", "time", r6("close", "close"))


@query(f"""{_DAILY} select symbol, time, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low, round(close, 6) as close, volume from d
  where symbol in ({', '.join(repr(s) for s in SYMBOLS)}) and open is not null and high is not null and low is not null and close is not null and volume is not null""")
def ohlcv_from_matrices(spark, sf):
    d = _daily(spark, sf)
    out = matrix.ohlcv({f: matrix.pivot(d, SYMBOLS, f) for f in matrix.FEATURES})
    return out.select("symbol", "time", *[r6(c, c) for c in clean.PRICES], "volume")


# Aggregates and scores.

_RULES = ["neg_open", "neg_high", "neg_low", "neg_close", "high_below_low", "high_below_open", "high_below_close", "low_above_open", "low_above_close", "neg_volume"]
_TESTS = ["open < 0", "high < 0", "low < 0", "close < 0", "high < low", "high < open", "high < close", "low > open", "low > close", "volume < 0"]


@query("with k as (select time, symbol, open, high, low, case when isnan(close) then null else close end as close, volume from candle) select count(*) as row_count, "
       + ", ".join(f"count(*) filter ({t}) as {n}" for n, t in zip(_RULES, _TESTS))
       + """, (count(*) * 7 - count(open) - count(high) - count(low) - count(close) - count(volume) - count(time) - count(symbol)) as nulls,
  count(*) - (select count(*) from (select distinct symbol, time from candle)) as duplicates, count(distinct symbol) as symbols, min(time) as min_time, max(time) as max_time from k""")  # fmt: skip
def validate_report(spark, sf):
    return validate.rule_counts(table(spark, sf, "candle"))


@query("""with r as (select symbol, time, bar_id, max(time) over (partition by symbol order by bar_id rows between unbounded preceding and 1 preceding) as m from candle where symbol is not null and time is not null)
  select symbol, count(*) as n_late from r where m > time group by symbol""")
def monotonic_check(spark, sf):
    return validate.unsorted_symbols(table(spark, sf, "candle"), "bar_id")


@query(f"""with {_GOOD}, v as (select symbol, case when volume > 0 then ln(1 + volume) end as v from good)
  select symbol, count(v) as n, round(case when count(v) < 90 then 0 else coalesce(avg(v) / (stddev_samp(v) + 1e-9), 0) end, 6) as stability from v group by symbol""")
def volume_stability(spark, sf):
    s = clean.stability(good(spark, sf), "symbol", "volume")
    return s.select("symbol", "n", r6("stability", "stability"))


@query(f"""with {_GOOD}, u as (select symbol, round(sum(quote_volume), 3) as liquidity, count(*) as age, round(avg(number_of_trades), 9) as activity from good group by symbol),
  k as (select symbol, (rank() over (order by liquidity) + (count(*) over (partition by liquidity) - 1) / 2) / count(*) over () as a,
    (rank() over (order by age) + (count(*) over (partition by age) - 1) / 2) / count(*) over () as b,
    (rank() over (order by activity) + (count(*) over (partition by activity) - 1) / 2) / count(*) over () as c from u)
  select symbol, round(0.5 * a + 0.3 * b + 0.2 * c, 6) as score from k order by score desc, symbol limit 40""")
def universe_score(spark, sf):
    u = good(spark, sf).groupBy("symbol").agg(F.round(F.sum("quote_volume"), 3).alias("liquidity"), F.count("*").alias("age"), F.round(F.avg("number_of_trades"), 9).alias("activity"))
    s = clean.scored(u, {"liquidity": 0.5, "age": 0.3, "activity": 0.2})
    return s.select("symbol", r6("score", "score")).orderBy(F.desc("score"), "symbol").limit(40)



def _two_sides(spark, sf):
    """Hourly bars of the ticks of even and of odd users: one instrument on two markets."""
    t = ticks(spark, sf).where("price is not null and volume is not null")
    return tuple(clean.resample(t.where(f"user_id % 2 = {i}"), "symbol", "time", 3600, "seq", price="price").drop("n") for i in (0, 1))


_SIDE = """select symbol, date_trunc('hour', time) as time, arg_min(price, (time, seq)) as open, max(price) as high, min(price) as low, arg_max(price, (time, seq)) as close, sum(volume)::bigint as volume
    from ticks where price is not null and volume is not null and user_id % 2 = {} group by 1, 2"""
_SPOT = f"with {_TICKS}, spot as ({_SIDE.format(0)}), dated as ({_SIDE.format(1)})"


@query(f"""{_SPOT} select symbol, count(*) as n, round(coalesce(median(case when b <> 0 and a / b > 0 and a / b < 1000 then a / b end), 1.0), 6) as ratio
  from (select s.symbol, s.volume as a, d.volume as b from spot s join dated d using (symbol, time)) group by symbol""")
def median_ratio_scale(spark, sf):
    return gaps.ratio_scale(*_two_sides(spark, sf)).select("symbol", "n", r6("ratio", "ratio"))


@query(f"""{_SPOT}, s as (select symbol, lag(time) over (partition by symbol order by time) as prev, time as next from spot),
  g as (select symbol, prev + interval 1 hour as a, next - interval 1 hour as b, date_diff('hour', prev, next) - 1 as missing from s where date_diff('hour', prev, next) > 1),
  few as (select * from g where missing <= 12),
  r as (select g.a, g.b, g.missing, d.* from few g join dated d on d.symbol = g.symbol and d.time between g.a and g.b),
  whole as (select symbol, a, b from r group by symbol, a, b, missing having count(*) = missing),
  sc as (select w.symbol, w.a, median(case when d.volume <> 0 and p.volume / d.volume > 0 and p.volume / d.volume < 1000 then p.volume / d.volume end) as scale
    from whole w join spot p on p.symbol = w.symbol and p.time between w.a - interval 24 hour and w.b + interval 24 hour join dated d on d.symbol = p.symbol and d.time = p.time group by 1, 2)
  select r.symbol, r.time, round(r.open, 6) as open, round(r.high, 6) as high, round(r.low, 6) as low, round(r.close, 6) as close, round(r.volume * coalesce(sc.scale, 1.0), 6) as volume, 'proxy_fill' as source
  from r join whole w using (symbol, a) left join sc using (symbol, a)""")
def proxy_fill(spark, sf):
    spot, other = _two_sides(spark, sf)
    out = gaps.proxy_fill(spot, other, 3600, 12, 24 * 3600, ["volume"], list(clean.PRICES))
    return out.select("symbol", "time", *[r6(c, c) for c in clean.PRICES], r6("volume", "volume"), "source")


# Order books and options.


@query(f"""with {_TICKS}, h as (select *, date_trunc('hour', time) as hour, max(time) over (partition by symbol, date_trunc('hour', time)) as m from ticks)
  select symbol, hour, time as sample_time, seq from h where time = m""")
def hourly_latest_snapshot(spark, sf):
    t = ticks(spark, sf).withColumn("hour", market.floor_time(F.col("time"), 3600))
    return clean.latest_per_bucket(t, ["symbol", "hour"], "time").select("symbol", "hour", F.col("time").alias("sample_time"), "seq")


_PCT = "case user_id % 4 when 0 then -1.0 when 1 then 1.0 when 2 then -0.2 else 0.2 end"
_SIDES = [("bid_depth_1pct", -1.0), ("ask_depth_1pct", 1.0), ("bid_depth_0_2pct", -0.2), ("ask_depth_0_2pct", 0.2)]


@query(f"""with {_TICKS}, b as (select symbol, date_trunc('hour', time) as time, {_PCT} as pct, price as depth, seq from ticks where price is not null), w as (select symbol, time, """
       + ", ".join(f"arg_max(depth, seq) filter (pct = {p}) as {n}" for n, p in _SIDES)
       + """ from b group by 1, 2) select symbol, time, """ + ", ".join(f"round({n}, 6) as {n}" for n, _ in _SIDES)
       + ", round((bid_depth_1pct - ask_depth_1pct) / nullif(bid_depth_1pct + ask_depth_1pct, 0), 6) as primary_imbalance from w")
def band_pivot_imbalance(spark, sf):
    t = ticks(spark, sf).where("price is not null").selectExpr("symbol", "seq", f"cast({_PCT} as double) as percentage", "price as depth", "price as notional", "time")
    wide = orderbook.bands_from_percentages(t.withColumn("time", market.floor_time(F.col("time"), 3600)), [0.002, 0.01], 0.01, ["symbol", "time"], "seq")
    return wide.select("symbol", "time", *[r6(n, n) for n, _ in _SIDES], r6("primary_imbalance", "primary_imbalance"))


_BOOK = """with b as (select vec_id, list_transform(generate_series(1, 32), lambda i: struct_pack(price := 100 - i::double / 4, qty := abs(embedding[i]::double))) as bids,
  list_transform(generate_series(1, 32), lambda i: struct_pack(price := 100 + i::double / 4, qty := abs(embedding[i + 32]::double))) as asks from embeddings)"""


@query(f"""{_BOOK}, d as (select vec_id, list_sum(list_transform(list_filter(bids, lambda x: x.price >= 100 * 0.99), lambda x: x.qty)) as b1, list_sum(list_transform(list_filter(asks, lambda x: x.price <= 100 * 1.01), lambda x: x.qty)) as a1,
  list_sum(list_transform(list_filter(bids, lambda x: x.price >= 100 * 0.95), lambda x: x.qty * x.price)) as n5, list_sum(list_transform(list_filter(asks, lambda x: x.price <= 100 * 1.05), lambda x: x.qty)) as a5 from b)
  select vec_id, 100.0::double as mid_price, 50.0::double as spread_bps, round(b1, 6) as bid_depth_1pct, round(a1, 6) as ask_depth_1pct, round(n5, 6) as bid_notional_5pct, round(a5, 6) as ask_depth_5pct, round((b1 - a1) / nullif(b1 + a1, 0), 6) as primary_imbalance from d""")
def depth_bands_array(spark, sf):
    side = lambda sign, off: F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.struct((100 + sign * i.cast("double") / 4).alias("price"), F.abs(F.element_at("embedding", i + off).cast("double")).alias("qty")))
    books = table(spark, sf, "embeddings").select("vec_id", side(-1, 0).alias("bids"), side(1, 32).alias("asks"))
    out = orderbook.bands_from_levels(books, [0.01, 0.05], 0.01)
    return out.select("vec_id", "mid_price", "spread_bps", *[r6(c, c) for c in ("bid_depth_1pct", "ask_depth_1pct", "bid_notional_5pct", "ask_depth_5pct", "primary_imbalance")])


@query("select bar_id, round((low + high) / 2, 6) as mid_price, round(high - low, 6) as spread, round((high - low) / nullif((low + high) / 2, 0) * 10000, 4) as spread_bps from candle")
def mid_spread_bps(spark, sf):
    lo, h = F.col("low"), F.col("high")
    return table(spark, sf, "candle").select("bar_id", r6(market.mid(lo, h), "mid_price"), r6(h - lo, "spread"), F.round(market.spread_bps(lo, h), 4).alias("spread_bps"))



def _option_marks(spark, sf):
    o = table(spark, sf, "orders")
    name = F.concat_ws("-", F.upper(F.regexp_replace(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)), " ", "")), F.date_format("o_orderdate", "yyMMdd"), (F.col("o_custkey") * 10).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "C").otherwise("P"))
    return o.select("o_orderkey", name.alias("symbol"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("custkey"))


_MARKS = """m as (select o_orderkey, upper(replace(split_part(o_orderpriority, '-', 2), ' ', '')) || '-' || strftime(o_orderdate, '%y%m%d') || '-' || (o_custkey * 10)::varchar || '-' || case when o_orderkey % 2 = 0 then 'C' else 'P' end as symbol,
  upper(replace(split_part(o_orderpriority, '-', 2), ' ', '')) as underlying, strptime('20' || strftime(o_orderdate, '%y%m%d'), '%Y%m%d')::date as expiry, (o_custkey * 10)::double as strike, case when o_orderkey % 2 = 0 then 'C' else 'P' end as type, o_totalprice as price, o_custkey as custkey from orders)"""


@query(f"with {_MARKS} select o_orderkey, underlying, expiry, strike, type from m where underlying <> ''")
def option_symbol_parse(spark, sf):
    return options.parsed(_option_marks(spark, sf)).select("o_orderkey", "underlying", "expiry", "strike", "type")


@query(f"""with {_MARKS}, e as (select underlying, expiry, dense_rank() over (partition by underlying order by expiry) as r from m where underlying <> '' and expiry >= date '2000-01-01')
  select m.o_orderkey, m.underlying, m.expiry from m join (select distinct underlying, expiry from e where r <= 3) using (underlying, expiry)""")
def nearest_expiries(spark, sf):
    return options.nearest_expiries(options.parsed(_option_marks(spark, sf)), 3, F.lit("2000-01-01").cast("date")).select("o_orderkey", "underlying", "expiry")


@query(f"""with {_MARKS}, t as (select symbol, arg_max(price, o_orderkey) as last_price from m group by symbol), s as (select underlying, max(price) as spot from m where underlying <> '' group by 1),
  e as (select distinct underlying, expiry, dense_rank() over (partition by underlying order by expiry) as r from m where underlying <> '' and expiry >= date '2000-01-01')
  select m.o_orderkey as mark_o_orderkey, m.symbol, round(m.price, 6) as mark_price, round(t.last_price, 6) as ticker_price, round(s.spot, 6) as spot
  from m join e using (underlying, expiry) left join t using (symbol) left join s using (underlying) where e.r <= 20""")
def mark_ticker_left_join(spark, sf):
    m = _option_marks(spark, sf)
    spots = options.parsed(m).groupBy("underlying").agg(F.max("price").alias("spot"))
    out = options.snapshot(m, m.select("symbol", "price", "o_orderkey"), spots, "o_orderkey", 20, F.lit("2000-01-01").cast("date"))
    return out.select("mark_o_orderkey", "symbol", r6("mark_price", "mark_price"), r6("ticker_price", "ticker_price"), r6("spot", "spot"))


# Streams and the lake.


def _event_stream(spark, sf):
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events*.parquet")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return raw.select(F.col("event_id").alias("seq"), F.col("ts").alias("time"), F.col("event_type").alias("symbol"), F.col("value").alias("price"), k.alias("volume"), "user_id")


@query(SQL["resample_ohlcv_1h"])
def streaming_bars(spark, sf):
    out = work_path(spark, "bars")
    bars = stream_events.bars(_event_stream(spark, sf), 3600, "1 hour")
    # Complete mode: the last bars come out too, though no later event closes them.
    found = []
    stream_events.run_available(bars, work_path(spark, "bars-checkpoint"), batch=lambda df, i: (df.write.mode("overwrite").parquet(f"{out}/{i}"), found.append(i)), mode="complete")
    done = spark.read.parquet(f"{out}/{max(found)}")
    return done.select("symbol", "time", *[r6(c, c) for c in clean.PRICES], "volume", "n")


@query(f"with {_TICKS} select seq, symbol, user_id from ticks")
def streaming_dedupe(spark, sf):
    path = work_path(spark, "deduped")
    twice = _event_stream(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    stream_events.run_available(stream_events.deduplicated(twice, ["seq"], "time", "40 days"), work_path(spark, "dedupe-checkpoint"), path)
    return spark.read.parquet(path).select("seq", "symbol", "user_id")


@query(f"""with {_TICKS}, s as (select distinct symbol, date_trunc('second', time) as t from ticks), l as (select symbol, lag(t) over (partition by symbol order by t) as p, t from s)
  select symbol, epoch(p)::bigint as prev_s, epoch(t)::bigint as next_s from l where date_diff('second', p, t) > 900""")
def streaming_gaps(spark, sf):
    path = work_path(spark, "gap-events")
    stream_events.run_available(stream_events.gap_events(_event_stream(spark, sf), 900), work_path(spark, "gaps-checkpoint"), path)
    return spark.read.parquet(path)


@query(f"""{_HALVES}, u as (select coalesce(n.symbol, o.symbol) as symbol, coalesce(n.time, o.time) as time, coalesce(n.price, o.price) as price from new n full join old o using (symbol, time))
  select symbol, time, round(price, 6) as price from u where symbol in ('view', 'click') and time >= timestamp '2024-01-08' and time <= timestamp '2024-01-22'""")
def lake_roundtrip(spark, sf):
    from bartide.registry import Dataset

    old, new = _halves(spark, sf)
    root = work_path(spark, "lake")
    sinks.upsert(old, f"{root}/ticks", ["symbol", "time"], order="seq")
    sinks.upsert(new, f"{root}/ticks", ["symbol", "time"], order="seq")
    ds = Dataset("ticks", "ticks")
    got = lake.scan(spark, root, ds, None, datetime(2024, 1, 8), datetime(2024, 1, 22))
    return got.where(F.col("symbol").isin("view", "click")).select("symbol", "time", r6("price", "price"))
