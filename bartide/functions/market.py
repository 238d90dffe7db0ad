"""Scalar expressions of market data; all are built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def no_nan(c: Column) -> Column:
    """NaN as null, so that comparisons and aggregates treat both alike."""
    return F.when(~F.isnan(c), c)


def strict_greatest(*cols: Column) -> Column:
    """The greatest value; null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.least(*cols))


def floor_time(c: Column, seconds: int) -> Column:
    """A TIMESTAMP_NTZ floored to a multiple of ``seconds`` within its day (``seconds`` divides a day)."""
    of_day = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    start = F.date_trunc("day", c).cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=(of_day - of_day % seconds).cast("decimal(18,6)"))


def add_seconds(c: Column, seconds) -> Column:
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return c + F.make_dt_interval(secs=s.cast("decimal(18,6)"))


def seconds_between(a: str, b: str) -> Column:
    """Whole seconds from column ``a`` to column ``b``."""
    return F.expr(f"timestampdiff(SECOND, `{a}`, `{b}`)")


def last_closed(now: Column, seconds: int) -> Column:
    """The start of the last period that has ended by ``now``."""
    return add_seconds(floor_time(now, seconds), -seconds)


def stream_price(c: Column) -> Column:
    """A price of a stream bar: two decimals, half to even; 0 where there is none."""
    return F.bround(F.coalesce(c, F.lit(0.0)), 2)


def dated_contract(symbol: Column, pairs: list[str] | None = None) -> Column:
    """Whether a symbol names a dated contract (PAIR_yymmdd, PAIR in USDT), of one of ``pairs`` if given."""
    s = F.upper(F.trim(symbol))
    named = s.rlike(r"^[A-Z0-9]+USDT_\d{6}$")
    return named if pairs is None else named & F.split_part(s, F.lit("_"), F.lit(1)).isin([p.upper() for p in pairs])


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    """Spread over mid in basis points; null where the mid is 0."""
    return (ask - bid) / F.nullif(mid(bid, ask), F.lit(0.0)) * 10_000


def imbalance(bid: Column, ask: Column) -> Column:
    """(bid - ask) / (bid + ask); null if either is null or the sum is 0."""
    return (bid - ask) / F.nullif(bid + ask, F.lit(0.0))


def epoch_to_time(v: Column) -> Column:
    """Epoch milliseconds or microseconds to TIMESTAMP_NTZ (UTC), each value by its own size; session zone must be UTC."""
    return F.when(F.abs(v) > 100_000_000_000_000, F.timestamp_micros(v)).otherwise(F.timestamp_millis(v)).cast("timestamp_ntz")


def option_part(symbol: Column, part: int) -> Column:
    """Parts of UNDERLYING-yymmdd-STRIKE-C|P by number 1 to 4; null if the symbol has another form."""
    pattern = r"^([A-Z0-9]+)-(\d{6})-(\d+(?:\.\d+)?)-([CP])$"
    return F.when(symbol.rlike(pattern), F.regexp_extract(symbol, pattern, part))


def delivery_date(symbol: Column) -> Column:
    """The date of a dated contract (SYMBOL_yymmdd), or null."""
    d = F.regexp_extract(symbol, r"_(\d{2})(\d{2})(\d{2})$", 0)
    return F.when(d != "", F.concat(F.lit("20"), F.substring(d, 2, 2), F.lit("-"), F.substring(d, 4, 2), F.lit("-"), F.substring(d, 6, 2))).try_cast("date")


def band_token(band: float) -> str:
    """0.01 to ``1pct``, 0.002 to ``0_2pct``."""
    return f"{band * 100:.8f}".rstrip("0").rstrip(".").replace(".", "_") + "pct"
