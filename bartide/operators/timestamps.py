"""Timestamps written in many ways, normalised to UTC microseconds.

Method: distinct raw strings with their source's zone and date order form a
dictionary; each is parsed once, by one exhaustive list of layouts; the dictionary
is persisted, in a folder that any later session opens again, and grows by the strings
it lacks; instants are joined back to rows.

Parsing and zone arithmetic are JVM expressions on whole microseconds and don't
depend on the session's time zone.

Defined results: null, blank, unreadable, impossible dates, a time of day without
a date, wall-clock times that a zone skips or repeats, and wall-clock times whose
zone is unknown give no instant (null). Repeated rows all get the same instant. An
empty table gives an empty result. Very long strings match no layout. Columns of the
caller's table are never renamed: the join uses names reserved by ``_td_``.
"""

from __future__ import annotations

import uuid
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.functions.market import let
from bartide.session import work_path
from bartide.sources import files

DAY_US, MIN_US, SEC_US = 86_400_000_000, 60_000_000, 1_000_000

#: Minutes east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "CEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "ICT": 420, "SGT": 480, "HKT": 480, "JST": 540,
    "KST": 540, "AEST": 600, "AEDT": 660, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
#: English months by their first three letters.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([AP])\.?M\.?)?"
_ZONE = r"(?: ?(Z|[A-Z]{2,5}|(?:GMT|UTC)?[+-]\d{1,2}(?::?\d{2})?))?(?: ?\[([A-Z][A-Z0-9_+/-]*)\])?"
_MONTH = r"(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)[A-Z]{0,6}\.?"
_NAME = r"(?:[A-Z]{3,9},? )?"
_SEP = r"(?:T|,? )"

#: Layouts as (pattern, rewriting to ``date parts|clock parts|zone|region``). D1 to D3
#: are numbers whose order the source's date_order tells.
_LAYOUTS = [
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:{_SEP}{_CLOCK})?{_ZONE}$", "ymd|$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T? ?(\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?)?(){_ZONE}$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10"),
    (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?:{_SEP}{_CLOCK})?{_ZONE}$", "src|$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    (rf"^{_CLOCK} (\d{{1,2}})([-/.])(\d{{1,2}})\7(\d{{4}}|\d{{2}}){_ZONE}$", "src|$6|$8|$9|$1|$2|$3|$4|$5|$10|$11"),
    (rf"^{_NAME}(\d{{1,2}})[- /.]{{1,2}}{_MONTH}[- /,]{{1,2}}(\d{{4}}|\d{{2}})(?:{_SEP}{_CLOCK})?{_ZONE}$", "dny|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10"),
    (rf"^{_NAME}{_MONTH} (\d{{1,2}}),? (\d{{4}})(?:{_SEP}{_CLOCK})?{_ZONE}$", "ndy|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10"),
]
_NUMBER = r"^[+-]?\d{1,20}(?:\.\d*)?(?:E[+]?\d{1,2})?$"
_SPELLED = r"^(?:19|20)\d{6}(?:\d{4}|\d{6})?$"
_BLANK_CHARS = " \t\n\r\x0b\x0c\xa0\ufeff\u200b"


def source_key(source: Column) -> Column:
    """A source's name apart from case and surrounding blanks."""
    return F.lower(F.btrim(source, F.lit(_BLANK_CHARS)))


def _wall_us(instant_us: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant_us), zone))


def with_instant(df: DataFrame, wall: str, zone: str, out: str) -> DataFrame:
    """Add ``out``: the one instant at which the clocks of ``zone`` show ``wall`` (microseconds), else null.

    The offsets a day before and a day after are the only ones that can hold. Where they agree, so does the time
    between; else a skipped time fits neither, and a repeated time fits both at two instants."""
    w, z = F.col(wall), F.col(zone)
    df = df.withColumns({"_td_o1": _wall_us(w - DAY_US, z) - (w - DAY_US), "_td_o2": _wall_us(w + DAY_US, z) - (w + DAY_US)})
    early, late = w - F.col("_td_o1"), w - F.col("_td_o2")
    fits_early, fits_late = _wall_us(early, z) == w, _wall_us(late, z) == w
    changing = F.when(fits_early & ~fits_late, early).when(fits_late & ~fits_early, late)
    return df.withColumn(out, F.when(F.col("_td_o1") == F.col("_td_o2"), early).otherwise(changing)).drop("_td_o1", "_td_o2")


def _known_zone(zone: Column) -> Column:
    """``zone`` where it is a zone of the tz database, else null."""
    return F.when(zone.isin(*sorted(available_timezones())), zone)


def parse_columns(df: DataFrame, raw: str, zone: str, order: str, out: str) -> DataFrame:
    """Add ``out``: the instant of column ``raw`` in UTC microseconds, or null."""
    keep = df.columns
    # A lambda ends a span of generated code. There are two, as one method of more than 8,000 bytes is never compiled by the JVM.
    v = let(F.btrim(F.col(raw), F.lit(_BLANK_CHARS)), lambda t: F.upper(F.regexp_replace(t, r"\s+", " ")))
    df = df.withColumn("_td_v", v)
    # A replacement that changes the text is a match: each layout is tried once, and none after the first that fits.
    layout = F.coalesce(*[F.nullif(F.regexp_replace("_td_v", pattern, parts), F.col("_td_v")) for pattern, parts in _LAYOUTS])
    is_number = F.col("_td_v").rlike(_NUMBER) & ~F.col("_td_v").rlike(_SPELLED)
    digits = F.regexp_replace("_td_v", r"(\.\d{12})\d+", "$1")  # picoseconds; what is finer is below the unit of the result
    df = df.withColumn("_td_n", F.when(is_number, digits.try_cast("decimal(38,12)")))
    df = df.withColumn("_td_p", F.when(~is_number, F.split(layout, r"\|", -1)))
    part = lambda i: F.get("_td_p", F.lit(i))
    kind = F.when(part(0) == "src", F.col(order)).otherwise(part(0))
    # Places of year, month and day among the parts, by the order of the layout.
    places = {"ymd": (1, 2, 3), "dmy": (3, 2, 1), "mdy": (3, 1, 2), "dny": (3, 2, 1), "ndy": (3, 1, 2)}
    at = F.lit(None).cast("array<int>")
    for name, ymd in places.items():
        at = F.when(F.col("_td_kind") == name, F.array(*map(F.lit, ymd))).otherwise(at)
    df = df.withColumn("_td_kind", kind).withColumn("_td_at", at)
    df = df.withColumn("_td_ymd", F.transform("_td_at", lambda i: F.get("_td_p", i)))
    piece = lambda i: F.get("_td_ymd", F.lit(i))
    month = F.when(piece(1).rlike("^[A-Z]"), F.array_position(F.array(*map(F.lit, MONTHS)), piece(1)).cast("string")).otherwise(piece(1))
    year = F.when(F.length(piece(0)) == 2, F.concat(F.lit("20"), piece(0))).otherwise(piece(0))
    df = df.withColumns({"_td_m": month, "_td_y": year, "_td_h": part(4).try_cast("int"), "_td_half": part(8)})
    # One text that the cast reads or refuses: it knows the days of months and the bounds of the clock.
    h, half = F.col("_td_h"), F.col("_td_half")
    hour = F.when(F.col("_td_half") == "", h).when(h.between(1, 12), h % 12 + F.when(half == "P", 12).otherwise(0)).otherwise(99)
    clock = F.concat(F.lit(" "), hour, F.lit(":"), part(5), F.lit(":"), F.when(part(6) == "", F.lit("00")).otherwise(part(6)), F.lit("."), F.when(part(7) == "", F.lit("0")).otherwise(F.substring(part(7), 1, 6)))
    text = F.concat(F.col("_td_y"), F.lit("-"), F.col("_td_m"), F.lit("-"), piece(2), F.when(part(4) == "", F.lit(" 0:0:0")).otherwise(clock), F.lit("Z"))
    df = df.withColumn("_td_wall", F.when(F.col("_td_y") != "0000", F.unix_micros(text.try_cast("timestamp"))))

    df = df.withColumns({"_td_z": F.regexp_replace(F.coalesce(part(9), F.lit("")), "^(GMT|UTC)(?=[+-])", ""), "_td_in": F.coalesce(part(10), F.lit(""))})
    z, inside = F.col("_td_z"), F.col("_td_in")
    digits = F.replace(F.substring(z, 2, 5), F.lit(":"), F.lit(""))
    offset = F.when(F.length(digits) <= 2, digits.try_cast("int") * 60).otherwise(F.left(digits, F.length(digits) - 2).try_cast("int") * 60 + F.right(digits, F.lit(2)).try_cast("int"))
    named = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    minutes = F.when(z.rlike("^[+-]"), F.when(offset <= 18 * 60, F.when(F.startswith(z, F.lit("-")), -offset).otherwise(offset))).otherwise(named[z])
    region = F.regexp_extract(F.col(raw), r"\[([^\]]*)\]", 1)
    df = df.withColumn("_td_min", F.when(z != "", minutes))
    df = df.withColumn("_td_zone", F.when(z == "", _known_zone(F.when(inside == "", F.col(zone)).otherwise(region))))
    df = with_instant(df, "_td_wall", "_td_zone", "_td_local")
    from_wall = F.when(z != "", F.col("_td_wall") - F.col("_td_min").cast("long") * MIN_US).otherwise(F.col("_td_local"))
    n = F.col("_td_n")
    number = F.when(F.abs(n) < 100_000_000_000, F.floor(n * 1_000_000)).when(F.abs(n) < 100_000_000_000_000, F.floor(n * 1000)).when(F.abs(n) < 100_000_000_000_000_000, F.floor(n)).otherwise(F.floor(n / 1000))
    instant = F.when(n.isNotNull(), number.try_cast("long")).otherwise(from_wall)
    return df.withColumn("_td_out", instant).select(*[F.col(f"`{k}`") for k in keep], F.col("_td_out").alias(out))


ENTRY = "raw string, source string, rule string, utc_us long"


class TimestampDictionary:
    """The persisted dictionary of distinct (raw, source, rule) and their instants; a rule is the source's zone and date order.

    Opening an existing path finds its entries. ``update`` parses the strings it lacks and adds them as one more folder,
    never touching older ones; a folder without its success marker (a job that was lost) is ignored. One writer at a time.
    Entries of rules that ``sources`` no longer gives stay, unused. ``sources``: source, zone_id, date_order, a small clean table."""

    def __init__(self, spark: SparkSession, sources: DataFrame, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "instants")
        known = sources.select(source_key(F.col("source")).alias("source"), "zone_id", "date_order").where(F.col("source").isNotNull())
        self.known = known.groupBy("source").agg(F.min(F.struct("zone_id", "date_order")).alias("_r")).select("source", "_r.*")

    def _ruled(self, df: DataFrame) -> DataFrame:
        """``df`` (source) with zone_id, date_order and rule."""
        return df.join(self.known, "source", "left").withColumn("rule", F.concat_ws("|", F.coalesce("zone_id", F.lit("")), F.coalesce("date_order", F.lit(""))))

    def entries(self) -> DataFrame:
        """raw, source, utc_us: what the dictionary holds under the present rules."""
        parts = [f"{self.path}/{n}" for n in files.names(self.spark, self.path) if n.startswith("part-") and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        if not parts:
            return self.spark.createDataFrame([], "raw string, source string, utc_us long")
        held = self.spark.read.schema(ENTRY).parquet(*parts)
        return self._ruled(held.withColumnRenamed("rule", "_then")).where(F.col("rule") == F.col("_then")).select("raw", "source", "utc_us")

    def update(self, raws: DataFrame) -> None:
        """``raws``: columns raw, source (as written)."""
        new = raws.where(F.col("raw").isNotNull()).select("raw", F.coalesce(source_key(F.col("source")), F.lit("")).alias("source")).distinct()
        if files.names(self.spark, self.path):
            new = new.join(self.entries().select("raw", "source"), ["raw", "source"], "left_anti")
        parsed = parse_columns(self._ruled(new), "raw", "zone_id", "date_order", "utc_us")
        parsed.select("raw", "source", "rule", "utc_us").write.parquet(f"{self.path}/part-{uuid.uuid4().hex}")

    def lookup(self, df: DataFrame, raw: str, source: str, out: str) -> DataFrame:
        """``df`` with ``out``: the instant of ``raw`` (null if it denotes none)."""
        entries = self.entries().where(F.col("utc_us").isNotNull()).select(F.col("raw").alias("_td_raw"), F.col("source").alias("_td_src"), F.col("utc_us").alias("_td_us"))
        left = df.withColumns({"_td_l": F.col(raw), "_td_k": F.coalesce(source_key(F.col(source)), F.lit(""))})
        joined = left.join(entries, (F.col("_td_l") == F.col("_td_raw")) & (F.col("_td_k") == F.col("_td_src")), "left")
        return joined.select(*[F.col(f"`{k}`") for k in df.columns], F.col("_td_us").alias(out))


def normalise(df: DataFrame, sources: DataFrame, columns: list[str], source: str = "source", key: str = "rec_id", path: str | None = None) -> DataFrame:
    """One row per (key, column of ``columns``) whose value denotes one instant: key, field_name, utc_us.

    With ``path``, the dictionary there is used and grows; values that it has aren't parsed again."""
    long = df.select(key, F.col(source).alias("_td_source"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("field_name"), F.col(name).cast("string").alias("raw")) for name in columns
    ])).alias("_td_x")).select(key, F.col("_td_source").alias("source"), "_td_x.field_name", "_td_x.raw").where(F.col("raw").isNotNull())
    book = TimestampDictionary(df.sparkSession, sources, path)
    book.update(long)
    return book.lookup(long, "raw", "source", "utc_us").where(F.col("utc_us").isNotNull()).select(key, "field_name", "utc_us")
