"""SQL of the instants that written times denote, for the queries that need them."""

from bartide.operators.timestamps import ABBREVIATIONS, MONTHS

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([AP])\.?M\.?)?"
_ZONE = r"(?: ?(Z|[A-Z]{2,5}|(?:GMT|UTC)?[+-]\d{1,2}(?::?\d{2})?))?(?: ?\[([A-Z][A-Z0-9_+/-]*)\])?"
_MONTH = rf"({'|'.join(MONTHS)})[A-Z]{{0,6}}\.?"
_DAY = r"(?:[A-Z]{3,9},? )?"
_AFTER = rf"(?:(?:T|,? ){_CLOCK})?"

#: Layouts: pattern and names of its groups; sa and sb are separators that must be alike.
_LAYOUTS = [
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})([-/.])(\d{{1,2}}){_AFTER}{_ZONE}$", "yy sa mm sb dd hh mi ss ff pp zz rr", "ymd"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T? ?(\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?)?{_ZONE}$", "yy mm dd hh mi ss ff zz rr", "ymd"),
    (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})([-/.])(\d{{4}}|\d{{2}}){_AFTER}{_ZONE}$", "dd sa mm sb yy hh mi ss ff pp zz rr", "src"),
    (rf"^{_CLOCK} (\d{{1,2}})([-/.])(\d{{1,2}})([-/.])(\d{{4}}|\d{{2}}){_ZONE}$", "hh mi ss ff pp dd sa mm sb yy zz rr", "src"),
    (rf"^{_DAY}(\d{{1,2}})[- /.]{{1,2}}{_MONTH}[- /,]{{1,2}}(\d{{4}}|\d{{2}}){_AFTER}{_ZONE}$", "dd mm yy hh mi ss ff pp zz rr", "dmy"),
    (rf"^{_DAY}{_MONTH} (\d{{1,2}}),? (\d{{4}}){_AFTER}{_ZONE}$", "mm dd yy hh mi ss ff pp zz rr", "mdy"),
]


def _read(pattern: str, names: str, kind: str) -> str:
    """One layout as a select of its parts; all of a day's parts are texts."""
    groups = names.split()
    at = lambda n: f"x.{n}" if n in groups else "''"
    swapped = kind == "src"
    day, month = ("case when date_order = 'mdy' then x.mm else x.dd end", "case when date_order = 'mdy' then x.dd else x.mm end") if swapped else (at("dd"), at("mm"))
    fits = "(x.sa = x.sb and (date_order in ('dmy', 'mdy')))" if swapped else "x.sa = x.sb" if "sa" in groups else "true"
    listed = "[" + ", ".join(f"'{n}'" for n in groups) + "]"
    return f"""select key, source_key, zone_id, v, raw, {at('yy')} as y, {month} as m, {day} as d, {at('hh')} as h, {at('mi')} as mi, {at('ss')} as s, {at('ff')} as f, {at('pp')} as p, {at('zz')} as z, {at('rr')} as r
        from (select *, regexp_extract(v, '{pattern}', {listed}) as x from texts where number is null and regexp_full_match(v, '{pattern}')) where {fits}"""


_ABBREVIATED = " ".join(f"when '{k}' then {v}" for k, v in ABBREVIATIONS.items())
_MONTH_NUMBERS = " ".join(f"when '{k}' then {i}" for i, k in enumerate(MONTHS, 1))


def instants(rows: str) -> str:
    """Common table expressions that end in ``instants`` (key, us), of ``rows``: a query of key, raw and source."""
    union = "\n        union all ".join(_read(*layout) for layout in _LAYOUTS)
    return rf"""known as (select lower(trim(source)) as source_key, any_value(zone_id) as zone_id, any_value(date_order) as date_order from feed_source group by 1),
    given as (select key, raw, lower(trim(source, ' ' || chr(9) || chr(10) || chr(13))) as source_key from ({rows}) where raw is not null),
    upper_texts as (select g.*, k.zone_id, k.date_order, upper(regexp_replace(trim(raw, ' ' || chr(9) || chr(10) || chr(13)), '\s+', ' ', 'g')) as v from given g left join known k using (source_key)),
    texts as (select *, case when regexp_full_match(v, '[+-]?\d{{1,20}}(\.\d*)?(E[+]?\d{{1,2}})?') and not regexp_full_match(v, '(19|20)\d{{6}}(\d{{4}}|\d{{6}})?') then v end as number from upper_texts),
    units as (select key, try_cast(number as decimal(38, 9)) as n from texts where number is not null),
    parts as ({union}),
    numbered as (select *, case when length(y) = 2 then 2000 + y::int else y::int end as year, case when regexp_full_match(m, '\d+') then m::int else case m {_MONTH_NUMBERS} end end as month,
        case when p = '' then coalesce(try_cast(h as int), 0) when h::int between 1 and 12 then h::int % 12 + case p when 'P' then 12 else 0 end else 99 end as hour from parts),
    walls as (select key, z, r, raw, zone_id,
        case when hour < 24 and coalesce(try_cast(mi as int), 0) < 60 and coalesce(try_cast(s as int), 0) < 60
            then try_cast(format('{{:04d}}-{{:02d}}-{{:02d}} {{:02d}}:{{:02d}}:{{:02d}}.{{}}', year, month, d::int, hour, coalesce(try_cast(mi as int), 0), coalesce(try_cast(s as int), 0), rpad(substr(f, 1, 6), 6, '0')) as timestamp) end as wall,
        regexp_replace(z, '^(GMT|UTC)([+-])', '\2') as zone from numbered),
    offsets as (select *, case when zone like '+%' or zone like '-%' then replace(substr(zone, 2), ':', '') end as digits from walls where wall is not null),
    zoned as (select key, wall, zone, coalesce(nullif(regexp_extract(raw, '\[([^\]]*)\]', 1), ''), zone_id) as region,
        case when digits is not null then (case when left(zone, 1) = '-' then -1 else 1 end) * (case when length(digits) <= 2 then digits::int * 60 else left(digits, length(digits) - 2)::int * 60 + right(digits, 2)::int end)
            else case zone {_ABBREVIATED} end end as minutes from offsets),
    places as (select z.key, z.wall, z.region from zoned z join (select name from pg_timezone_names()) n on n.name = z.region where z.zone = ''),
    guesses as (select key, wall, unnest([timezone(region, wall) + interval 3 hour * i / 6 for i in generate_series(-6, 6)]) as moment, region from places),
    fits as (select key, min(epoch_us(moment)) as us from guesses where timezone(region, moment) = wall group by key having count(distinct moment) = 1),
    instants as (
        select key, case when abs(n) < 100000000000 then floor(n * 1000000) when abs(n) < 100000000000000 then floor(n * 1000) when abs(n) < 100000000000000000 then floor(n) else floor(n / 1000) end::bigint as us from units where n is not null
        union all select key, epoch_us(wall) - minutes::bigint * 60000000 from zoned where zone <> '' and abs(minutes) <= 1080
        union all select key, us from fits)"""


WRITTEN = """select {'r': rec_id, 'f': 'time'} as key, time as raw, source from candle_feed union all select {'r': rec_id, 'f': 'ingested_at'}, ingested_at, source from candle_feed"""
FOUND = f"with {instants(WRITTEN)} select key.r as rec_id, key.f as field_name, us as utc_us from instants"
