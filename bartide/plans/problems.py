"""The queries of the general data-preparation operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bartide.operators import drift, grid, spikes, timestamps
from bartide.plans import instants
from bartide.session import cut, work_path
from bartide.sources.tables import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return timestamps.normalise(table(spark, sf, "candle_feed"), table(spark, sf, "feed_source"), ["time", "ingested_at"])


def p2_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of p2_found, of each source's values in turn, the dictionary opened again for each; the last turn parses nothing."""
    feed, sources, path = table(spark, sf, "candle_feed"), table(spark, sf, "feed_source"), work_path(spark, "instants")
    known = timestamps.source_key(F.col("source"))
    for r in sources.select("source").orderBy("source").collect():
        timestamps.normalise(feed.where(known == r.source), sources, ["time", "ingested_at"], path=path)
    return timestamps.normalise(feed, sources, ["time", "ingested_at"], path=path)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf).where("missing").select("symbol", "slot_s")


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return grid.regular(table(spark, sf, "candle"), table(spark, sf, "collect_window"))


def p3_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf).withColumns({"close": F.round("close", 6), "coverage": F.round("coverage", 6)})


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return spikes.flag(table(spark, sf, "candle"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.changes(table(spark, sf, "depth_line"), table(spark, sf, "depth_file")).select("file_id", "change_kind", "field_name")


def p5_union(spark: SparkSession, sf: str) -> DataFrame:
    return drift.union_schema(drift.alternatives(table(spark, sf, "depth_line")))


def p5_appearing(spark: SparkSession, sf: str) -> DataFrame:
    return drift.appearing(cut(drift.alternatives(table(spark, sf, "depth_line")), "alternatives"), table(spark, sf, "depth_file"))


def p5_table(spark: SparkSession, sf: str) -> DataFrame:
    return drift.consistent(table(spark, sf, "depth_line"), table(spark, sf, "depth_file")).withColumn("other_types", F.to_json("other_types"))


QUERIES = {
    "p2_found": p2_found,
    "p2_batches": p2_batches,
    "p3_found": p3_found,
    "p3_grid": p3_grid,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_union": p5_union,
    "p5_appearing": p5_appearing,
    "p5_table": p5_table,
}

_PATHS = r"""
        with lines as (select line_id, file_id, payload from depth_line where json_valid(payload) and json_type(payload) = 'OBJECT' and file_id is not null),
        v as (select l.file_id, l.line_id, replace(regexp_replace(substr(t.fullkey, 3), '\[[0-9]+\]', '[]', 'g'), '"', '') as field_name,
                case t.type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' when 'OBJECT' then 'object' else 'number' end as json_type
            from lines l, json_tree(l.payload) t where t.fullkey <> '$' and t.type <> 'NULL'),
        a as (select file_id, field_name, json_type, count(distinct line_id) as n from v group by 1, 2, 3)"""

SQL = {
    "p2_found": instants.FOUND,
    "p2_batches": instants.FOUND,
    "p5_union": f"""{_PATHS}
        select field_name, json_type, sum(n)::bigint as n_values, count(*) as n_files, min(file_id) as first_file_id, max(file_id) as last_file_id from a group by 1, 2""",
    "p5_appearing": f"""{_PATHS}, f as (select a.*, d.feed, d.file_seq from a join depth_file d using (file_id)),
        o as (select feed, field_name, json_type, min((file_seq, file_id)) as at from f group by 1, 2, 3), b as (select feed, min((file_seq, file_id)) as begun from f group by feed)
        select o.at[2] as file_id, o.feed, o.field_name, o.json_type,
            coalesce((select string_agg(p.json_type, ',' order by p.json_type) from o p where p.feed = o.feed and p.field_name = o.field_name and p.at < o.at), '') as other_types
        from o join b using (feed) where o.at > b.begun""",
    "p3_grid": """
        with r as (
            select symbol, epoch_us(time) as t, arg_max(close, bar_id) as v, count(*) as n from candle
            where time is not null and symbol is not null and close is not null and not isnan(close) group by 1, 2),
        s as (select *, coalesce(lead(t) over (partition by symbol order by t), 9000000000000000) as nx from r),
        w as (
            select window_id, symbol, epoch_us(start_time) as w0, step_s * 1000000::bigint as st,
                unnest(generate_series(0, (epoch_us(end_time) - epoch_us(start_time) + step_s * 1000000::bigint - 1) // (step_s * 1000000::bigint) - 1)) as k
            from collect_window),
        g as (select window_id, symbol, w0 + k * st as p, st from w),
        o as (
            select g.window_id, g.symbol, g.p, g.st, s.t, s.v, s.n, case when s.t is null then 0 else greatest(0, least(s.nx, g.p + g.st, s.t + g.st) - greatest(s.t, g.p)) end as l
            from g left join s on s.symbol = g.symbol and s.t < g.p + g.st and s.nx > g.p),
        a as (
            select window_id, symbol, p, st, coalesce(sum(n) filter (t >= p), 0)::bigint as n_readings, coalesce(sum(l), 0) as len, sum(v * l) as area, arg_max(v, t) as known
            from o group by 1, 2, 3, 4)
        select window_id, symbol, p // 1000000 as slot_s, n_readings, round(case when len > 0 then area / len else known end, 6) as close,
            round(len / st, 6) as coverage, n_readings = 0 as missing from a""",
    "p3_found": """
        with periods as (
            select symbol, step_s, unnest(generate_series(epoch_us(start_time), epoch_us(end_time) - 1, step_s * 1000000::bigint)) as p
            from collect_window),
        readings as (
            select symbol, epoch_us(time) as t from candle where time is not null and close is not null and not isnan(close))
        select g.symbol, g.p // 1000000 as slot_s from periods g
        where not exists (select 1 from readings r where r.symbol = g.symbol and r.t >= g.p and r.t < g.p + g.step_s * 1000000::bigint)""",
}
