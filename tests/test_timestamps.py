import glob
import os
import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from bartide.operators import timestamps as ts

SOURCES = [("a", "UTC", "ymd"), ("ny", "America/New_York", "mdy"), ("ldn", "Europe/London", "dmy"), ("hcm", "Asia/Ho_Chi_Minh", "dmy"), ("ber", "Europe/Berlin", "dmy"), ("lh", "Australia/Lord_Howe", "dmy"), ("bad", "Mars/Olympus", "dmy")]


def us(*a, micro=0):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp()) * 1_000_000 + micro


CASES = [
    ("2024-03-05T06:07:08Z", "ny", us(2024, 3, 5, 6, 7, 8)), ("2024-03-05 06:07:08", "ny", us(2024, 3, 5, 11, 7, 8)), ("03/05/2024 06:07", "ny", us(2024, 3, 5, 11, 7)),
    ("03/05/2024 06:07", "ldn", us(2024, 5, 3, 5, 7)), ("20240305T060708Z", None, us(2024, 3, 5, 6, 7, 8)), ("20240305060708", "hcm", us(2024, 3, 4, 23, 7, 8)),
    ("1709618828", None, us(2024, 3, 5, 6, 7, 8)), ("1709618828123", None, us(2024, 3, 5, 6, 7, 8, micro=123000)), ("1709618828123456", None, us(2024, 3, 5, 6, 7, 8, micro=123456)),
    ("1709618828.5", "zzz", us(2024, 3, 5, 6, 7, 8, micro=500000)), ("1.709618828E12", None, us(2024, 3, 5, 6, 7, 8)), ("1709618828123456789", None, us(2024, 3, 5, 6, 7, 8, micro=123456)),
    ("05.03.2024 06:07:08,25", "ber", us(2024, 3, 5, 5, 7, 8, micro=250000)), ("10:39 25/08/23", "hcm", us(2023, 8, 25, 3, 39)), ("Mar 5, 2024 1:07:08 PM", "ny", us(2024, 3, 5, 18, 7, 8)),
    ("5-Mar-2024 06:07", "hcm", us(2024, 3, 4, 23, 7)), ("Tue, 05 Mar 2024 06:07:08 +0530", None, us(2024, 3, 5, 0, 37, 8)), ("2024-03-05T06:07:08-05:00[America/New_York]", None, us(2024, 3, 5, 11, 7, 8)),
    ("2024-03-05T06:07:08[America/New_York]", None, us(2024, 3, 5, 11, 7, 8)), ("2024-10-27 02:15:00 CEST", "ber", us(2024, 10, 27, 0, 15)), ("2024-10-27 02:15:00 CET", "ber", us(2024, 10, 27, 1, 15)),
    ("2024-10-27 02:15:00", "ber", None), ("2024-03-31 02:15:00", "ber", None), ("3/10/2024 2:16 AM", "ny", None), ("3/10/2024 12:16 AM", "ny", us(2024, 3, 10, 5, 16)),
    ("2024-02-30 00:00:00", "a", None), ("2024-13-07 09:00:00", "a", None), ("2024-11-05 25:10:00", "a", None), ("2023-02-29T00:00:00Z", "a", None), ("14:35", "a", None), ("pending", "a", None),
    ("", "a", None), (None, "a", None), ("2024-03-05 06:07:08", None, None), ("2024-03-05 06:07:08", "zzz", None), ("2024-03-05 06:07:08", "bad", None), (" 2024-03-05T06:07:08z\n", " NY ", us(2024, 3, 5, 6, 7, 8)),
    ("2024-04-07 01:45:00", "lh", None), ("2024-10-06 02:15:00", "lh", None), ("2024-03-05", "a", us(2024, 3, 5)), ("20241301000000", "a", None), ("x" * 5000, "a", None),
]


def test_cases_and_increments(spark, tmp_path):
    sources = spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string")
    rows = spark.createDataFrame([(i, raw, src, 1) for i, (raw, src, _) in enumerate(CASES)], "rec_id int, raw string, source string, utc_us int")
    # Two sessions add to the dictionary at one path, a third reads it.
    path = str(tmp_path / "book")
    ts.TimestampDictionary(spark.newSession(), sources, path).update(rows.where("rec_id % 2 = 0"))
    held = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*")}
    other = ts.TimestampDictionary(spark.newSession(), sources, path)
    other.update(rows)  # parses only what it lacks
    other.update(rows)
    assert held == {f: os.path.getmtime(f) for f in held}
    shutil.copytree(glob.glob(f"{path}/part-*")[0], f"{path}/part-lost", ignore=shutil.ignore_patterns("_SUCCESS"))
    book = ts.TimestampDictionary(spark, sources, path)
    assert book.entries().count() == book.entries().select("raw", "source").distinct().count() == len({(r, (s or "").strip().lower()) for r, s, _ in CASES if r is not None})
    got = {r.rec_id: r.found for r in book.lookup(rows.union(rows), "raw", "source", "found").collect()}
    assert [(CASES[i], got[i]) for i in range(len(CASES)) if got[i] != CASES[i][2]] == []


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_session_zone_does_not_matter(spark, zone):
    sources = spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string")
    feed = spark.createDataFrame([(1, "2024-07-05 06:07:08", "ber", None)], "rec_id long, time string, source string, ingested_at string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [tuple(r) for r in ts.normalise(feed, sources, ["time", "ingested_at"]).collect()] == [(1, "time", us(2024, 7, 5, 4, 7, 8))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty(spark):
    sources = spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string")
    feed = spark.createDataFrame([], "rec_id long, time string, source string, ingested_at string")
    assert ts.normalise(feed, sources, ["time", "ingested_at"]).count() == 0
    assert ts.normalise(feed.union(spark.sql("select 1L, null, null, null")), sources, ["time"]).select(F.count("*")).first()[0] == 0


def test_padded_values_are_read(spark, tmp_path):
    raws = [" " * 500 + "2024-03-05T06:07:08Z" + "\n" * 500, "2024-03-05" + " " * 500 + "06:07:08Z", " " * 500 + "1709618828", " " * 200_000 + "x" + " " * 200_000 + "x", "1" * 200_000, "2024-" * 40_000]
    rows = spark.createDataFrame([(raw, "a") for raw in raws], "raw string, source string")
    book = ts.TimestampDictionary(spark, spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string"), str(tmp_path / "book"))
    book.update(rows)
    got = {r.raw: r.found for r in book.lookup(rows, "raw", "source", "found").collect()}
    assert [got[r] for r in raws] == [us(2024, 3, 5, 6, 7, 8)] * 3 + [None] * 3


def test_a_source_that_moves_is_parsed_anew(spark, tmp_path):
    rows = spark.createDataFrame([("2024-07-05 06:07:08", "ber")], "raw string, source string")
    for zone, hour in (("Europe/Berlin", 4), ("Asia/Tokyo", 21), ("Europe/Berlin", 4)):
        book = ts.TimestampDictionary(spark, spark.createDataFrame([("ber", zone, "dmy")], "source string, zone_id string, date_order string"), str(tmp_path / "book"))
        book.update(rows)
        assert [r.found for r in book.lookup(rows, "raw", "source", "found").collect()] == [us(2024, 7, 5 if hour == 4 else 4, hour, 7, 8)]
    assert ts.TimestampDictionary(spark, spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string"), str(tmp_path / "book")).entries().count() == 1


def test_fine_decimals_of_numbers(spark):
    sources = spark.createDataFrame(SOURCES, "source string, zone_id string, date_order string")
    feed = spark.createDataFrame([(1, "1709618828.1234567890123456", "a", None), (2, "-1.5", "a", None)], "rec_id long, time string, source string, ingested_at string")
    assert sorted(tuple(r) for r in ts.normalise(feed, sources, ["time"]).collect()) == [(1, "time", us(2024, 3, 5, 6, 7, 8, micro=123456)), (2, "time", -1_500_000)]
