"""Trading calendars as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Exchange holidays.
VN_HOLIDAYS = [
    "2024-01-01", "2024-02-08", "2024-02-09", "2024-02-12", "2024-02-13", "2024-02-14", "2024-04-18", "2024-04-30", "2024-05-01", "2024-09-02",
    "2025-01-01", "2025-01-27", "2025-01-28", "2025-01-29", "2025-01-30", "2025-01-31", "2025-04-07", "2025-04-30", "2025-05-01", "2025-09-01", "2025-09-02",
    "2026-01-01", "2026-02-16", "2026-02-17", "2026-02-18", "2026-02-19", "2026-02-20", "2026-04-27", "2026-04-30", "2026-05-01", "2026-09-02",
]
#: Session bounds as hhmm, both ends included.
STOCK_SESSIONS = [(900, 1130), (1300, 1445)]
DERIVATIVE_SESSIONS = [(845, 1130), (1300, 1445)]


def holidays(spark: SparkSession, days: list[str] | None = None) -> DataFrame:
    """A one-column table (day) of holidays; ``days`` replaces the fixed list."""
    rows = [(d,) for d in (VN_HOLIDAYS if days is None else days)]
    return spark.createDataFrame(rows, "day string").select(F.to_date("day").alias("day"))


def in_session(time: Column, sessions: list[tuple[int, int]]) -> Column:
    """A weekday and within a session, by the wall clock of ``time``."""
    hhmm = F.hour(time) * 100 + F.minute(time)
    inside = F.lit(False)
    for a, b in sessions:
        inside = inside | hhmm.between(a, b)
    return (F.weekday(time) < 5) & inside


def trading_hours(df: DataFrame, time: str, days: DataFrame, sessions: list[tuple[int, int]] = STOCK_SESSIONS) -> DataFrame:
    """Rows in a session on no holiday. ``days`` is a calendar (one row per holiday); an anti join drops its rows."""
    day = F.col(time).cast("date")
    return df.where(in_session(F.col(time), sessions)).withColumn("_day", day).join(days.withColumnRenamed("day", "_day"), "_day", "left_anti").drop("_day")


def session_minutes(spark: SparkSession, first, days: int, off: DataFrame, sessions: list[tuple[int, int]] = STOCK_SESSIONS) -> DataFrame:
    """The minutes (time) of all sessions in ``days`` days from ``first`` on; ``off``: holidays."""
    minutes = spark.range(days * 1440).select((F.lit(first).cast("date").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("time"))
    return trading_hours(minutes, "time", off, sessions)


def next_session(minutes: DataFrame, time: str, now: Column) -> DataFrame:
    """The first time of a table of session minutes after ``now`` (one row, null if there is none)."""
    return minutes.where(F.col(time) > now).agg(F.min(time).alias("next_session"))


def wait_for_session(spark: SparkSession, nows: DataFrame, off: DataFrame, sessions: list[tuple[int, int]] = STOCK_SESSIONS, days: int = 14, otherwise_s: int = 3600) -> DataFrame:
    """``nows`` (now, on the exchange's wall clock) with next_session, the first session minute after its own, and wait_s: the
    seconds to five past it, at least five; ``otherwise_s`` where none comes within ``days`` days.

    The calendar is a table of days with their session; a moment meets the days that follow it, not their minutes."""
    span = nows.agg(F.min("now").alias("a"), F.max("now").alias("b")).select(F.explode(F.sequence(F.col("a").cast("date"), F.date_add(F.col("b").cast("date"), days))).alias("day"))
    open_days = span.where(F.weekday("day") < 5).join(off.select("day"), "day", "left_anti")
    clock = lambda hhmm: F.make_dt_interval(hours=F.lit(hhmm // 100), mins=F.lit(hhmm % 100))
    opened = open_days.select("day", F.inline(F.array(*[F.struct((F.col("day").cast("timestamp_ntz") + clock(a)).alias("_a"), (F.col("day").cast("timestamp_ntz") + clock(b)).alias("_b")) for a, b in sessions])))
    at = F.date_trunc("minute", F.col("now")).cast("timestamp_ntz") + F.expr("interval 1 minute")
    asked = nows.select("now").distinct().withColumn("_t", at).withColumn("day", F.explode(F.sequence(F.col("_t").cast("date"), F.date_add(F.col("_t").cast("date"), days))))
    hit = asked.join(opened, "day").where("_b >= _t").groupBy("now").agg(F.min(F.greatest("_a", "_t")).alias("next_session"))
    wait = F.greatest(F.expr("timestampdiff(SECOND, now, next_session + interval 5 seconds)"), F.lit(5))
    return nows.join(hit, "now", "left").withColumn("wait_s", F.when(F.col("next_session").isNull(), F.lit(otherwise_s).cast("long")).otherwise(wait))
