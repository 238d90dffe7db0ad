"""SQL for the queries of the training-data operators, where SQL can say them."""

from bartide.plans.instants import WRITTEN, instants

_NEAR = "abs({a}.us - {b}.us) <= 10000000 and " + " and ".join(
    f"({{a}}.{n} is null or {{b}}.{n} is null or abs({{a}}.{n} - {{b}}.{n}) <= {r} * greatest(abs({{a}}.{n}), abs({{b}}.{n})))"
    for n, r in (("open", 0.001), ("high", 0.001), ("low", 0.001), ("close", 0.001), ("volume", 0.01))
)
_NUMBERS = ", ".join(f"case when isnan({n}) then null else {n} end as {n}" for n in ("open", "high", "low", "close", "volume"))

#: Rows of the batches in order of arrival, each with the accepted rows so far: a step of the recursion is a row.
REPEATS = f"""
    with recursive h as (select bar_id as id, regexp_replace(upper(symbol), '[^A-Z0-9]', '', 'g') as key, epoch_us(time) as us, {_NUMBERS} from candle where time is not null and symbol is not null),
    b as (select in_id as id, regexp_replace(upper(translate(symbol, '{"".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c - 0xFEE0).isalnum())}', '{"".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F) if chr(c - 0xFEE0).isalnum())}')), '[^A-Z0-9]', '', 'g') as key,
        epoch_us(time) as us, {_NUMBERS} from candle_batch where time is not null and symbol is not null),
    old as (select b.id, min(h.id) as kept from b join h on h.key = b.key and b.key <> '' and {_NEAR.format(a="b", b="h")} group by b.id),
    pairs as (select b.id, list(c.id) as earlier from b join b c on c.key = b.key and b.key <> '' and c.id < b.id and {_NEAR.format(a="b", b="c")} group by b.id),
    n as (select b.id, row_number() over (order by b.id) as pos, old.kept, coalesce(pairs.earlier, []) as earlier from b left join old using (id) left join pairs using (id)),
    step(pos, accepted, id, kept) as (
        select 0::bigint, []::bigint[], null::bigint, null::bigint
        union all
        select n.pos, case when n.kept is null and not list_has_any(s.accepted, n.earlier) then list_append(s.accepted, n.id) else s.accepted end, n.id,
            least(n.kept, list_min(list_intersect(s.accepted, n.earlier)))
        from step s join n on n.pos = s.pos + 1)
    select kept as kept_id, id as in_id from step where kept is not null"""

_NUMBER = r"[+-]?((\d{1,3}(,\d{3})+|\d+)(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
_SAID = " union all ".join(
    f"select rec_id, '{f}' as field_name, {f} as said, {least} as least from candle_feed"
    for f, least in [(f, 0) for f in ("open", "high", "low", "close")] + [(f, -1) for f in ("volume", "quote_volume", "number_of_trades")]
)

#: The most trusted source's value, then the latest, then that of the largest id.
CHOSEN = f"""
    with {instants(WRITTEN)},
    ranks as (select lower(trim(source)) as src, min(trust_rank) as trust_rank from feed_source group by 1),
    recs as (select c.rec_id, upper(trim(c.symbol)) as sym, t.us, -coalesce(r.trust_rank, 1000000) as rank, coalesce(i.us, -4000000000000000000) as ingested
        from candle_feed c join instants t on t.key.r = c.rec_id and t.key.f = 'time' left join instants i on i.key.r = c.rec_id and i.key.f = 'ingested_at'
        left join ranks r on r.src = lower(trim(c.source)) where c.symbol is not null),
    grouped as (select *, min(rec_id) over g as group_id, count(*) over g as n from recs window g as (partition by sym, us)),
    said as (select rec_id, field_name, case when regexp_full_match(trim(said), '{_NUMBER}') then try_cast(replace(trim(said), ',', '') as double) end as v, least from ({_SAID})),
    usable as (select rec_id, field_name from said where isfinite(v) and case when least = 0 then v > 0 else v >= 0 end)
    select group_id, field_name, arg_max(g.rec_id, (rank, ingested, g.rec_id)) as rec_id from grouped g join usable using (rec_id) where n >= 2 group by 1, 2"""

_BLANK = r"\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

#: Words of the tokenizer's splitting pattern. It looks ahead, for the last blank before a word; here a sign put before that blank does.
WORDS = rf"""
    with texts as (select regexp_replace(replace(text, chr(57344), chr(65533)), '([{_BLANK}])([{_BLANK}][^{_BLANK}])', '\1' || chr(57344) || '\2', 'g') as t from documents where text is not null),
    words as (select unnest(regexp_extract_all(t, '\x{{e000}}|''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANK}\p{{L}}\p{{N}}\x{{e000}}]+|[{_BLANK}]+')) as w from texts)
    select hex(encode(w)) as word_hex, count(*) as n from words where w <> chr(57344) group by 1"""

SQL = {"p7_words": WORDS, "p1_found": CHOSEN, "p6_found": REPEATS, "p6_batches": REPEATS}
