"""SQL of the p queries, for the engine that checks them (DuckDB dialect)."""

from tracewell.functions import money

_UUID = r"nullif(lower(regexp_replace({0}, '^[\s{{]+|[\s}}]+$', '', 'g')), '')"

_CHILD = f"""
child as (
  select distinct 'classifications' as table_name, id as row_key, cse_filing_id::varchar as fk, classified_at as t, 'filings' as parent from classifications
  union all
  select distinct 'issuer_decisions', id::varchar, {_UUID.format("issuer_id")}, decided_at, 'issuers' from issuer_decisions
  union all
  select distinct 'extraction_runs', f5_run_id, {_UUID.format("classification_id")}, recorded_at, 'classifications' from extraction_runs
),
parent as (
  select parent, key, coalesce(min(here), min(gone)) as valid_from, min(valid_to) as valid_to from (
    select 'filings' as parent, cse_filing_id::varchar as key, first_seen_at as here, null::timestamptz as gone, null::timestamptz as valid_to from filings
    union all select 'issuers', {_UUID.format("issuer_id")}, created_at, null, retired_at from issuers
    union all select 'classifications', {_UUID.format("id")}, classified_at, null, null from classifications
    union all select table_name, {_UUID.format("row_key")}, null, created_at, removed_at from removed_rows
  ) group by all
),
failed as (
  select c.table_name, c.row_key, strftime(c.t::timestamptz at time zone 'UTC', '%Y-%m') as month_utc,
    case when p.key is null then 'missing' when p.valid_to <= c.t then 'removed' when p.valid_from > c.t then 'late' end as kind
  from child c left join parent p on p.parent = c.parent and p.key = c.fk where c.fk is not null
)"""

_ITEM_KEYS = ("authorizedDate", "fileText", "id", "manualDate", "name", "path", "path2", "symbol", "uploadedDate")


def _content(item: str) -> str:
    """Content of an entry as JSON values side by side; an absent key is ``-``."""
    return "concat_ws('~', " + ", ".join(f"coalesce(json_extract({item}::json, '$.{k}')::varchar, '-')" for k in _ITEM_KEYS) + ")"


def _canonical(item: str) -> str:
    """Content of an entry as JSON with sorted keys; an absent key is left out."""
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{k}":' || json_extract({item}::json, '$.{k}')::varchar""" for k in _ITEM_KEYS) + ") || '}'"


_OBSERVED = """
obs as (
  select delivery_no, cse_filing_id, observed_at,
    regexp_replace(lower(trim(source_endpoint)), '^/api/', '') as ep,
    coalesce(nullif(case regexp_replace(lower(trim(source_bucket)), '^/api/', '')
      when 'infoannualdata' then 'annual' when 'infoquarterlydata' then 'quarterly' when 'infootherdata' then 'other' when 'infoweblink' then 'web_link'
      else regexp_replace(lower(trim(source_bucket)), '^/api/', '') end, ''), 'none') as bk,
    """ + _content("raw_item") + """ as content
  from filing_observations where cse_filing_id is not null
),
ranked as (select *, row_number() over (partition by cse_filing_id, ep, bk, content order by observed_at nulls last, delivery_no) as rn from obs)"""

_KNOWN = "with " + _OBSERVED + """,
events as (
  select distinct 'extraction_runs' as table_name, f5_run_id as row_key, cse_filing_id, recorded_at as t from extraction_runs
  union all select 'knowledge_views', view_id::varchar, cse_filing_id, known_at from knowledge_views
),
dec as (
  select e.table_name, e.row_key, e.cse_filing_id, e.t, max(d.id) filter (where d.decided_at <= e.t) as decision_id, max(d.id) filter (where d.decided_at is not null) as final_decision
  from events e left join issuer_decisions d on d.cse_filing_id = e.cse_filing_id group by all
),
known as (
  select d.*, arg_max(o.delivery_no, (o.observed_at, o.delivery_no)) filter (where o.observed_at <= d.t) as delivery_no, arg_max(o.delivery_no, (o.observed_at, o.delivery_no)) filter (where o.observed_at is not null) as final_delivery
  from dec d left join (select * from ranked where rn = 1) o on o.cse_filing_id = d.cse_filing_id group by all
)
select table_name, row_key, coalesce(decision_id, -1) as decision_id, coalesce(delivery_no, -1) as delivery_no from known"""

_COMPANIES = """
with texts as (select distinct raw_id, try_cast(body as json) as j from company_info_raw where json_valid(body)),
opened as (select raw_id, case when json_type(j) = 'VARCHAR' then try_cast(json_extract_string(j, '$') as json) else j end as j from texts),
lists as (
  select raw_id, true as many, j from opened where json_type(j) = 'ARRAY'
  union all select raw_id, true, j->'bodies' from opened where json_type(j->'bodies') = 'ARRAY'
  union all select raw_id, false, j->'body' from opened where json_type(j->'body') = 'OBJECT'
  union all select raw_id, false, j from opened where json_type(j) = 'OBJECT' and (j->'bodies') is null and (j->'body') is null
),
companies as (
  select raw_id, i::int as company_no, json_extract(j, '$[' || i || ']') as c from (select raw_id, j, unnest(range(json_array_length(j)::bigint)) as i from lists where many)
  union all select raw_id, 0, j from lists where not many
)"""

# Forms of instants that the tables hold, as this engine's own parser reads them, and minutes of the zones named.
_FORMS = (
    "%Y-%m-%dt%H:%M:%S.%f", "%Y-%m-%dt%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y%m%d%H%M%S", "%d%b%Y%H%M%S", "%d-%b-%Y %H:%M:%S", "%d %b %Y %I:%M:%S %p", "%d %b %Y %I:%M %p", "%d %b %Y %H:%M:%S", "%d %b %Y",
    "%a, %d %b %Y %H:%M:%S", "%B %d, %Y %H:%M", "%d.%m.%Y %H:%M", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y",
)
_NAMED = {"z": 0, "utc": 0, "gmt": 0, "bst": 60, "est": -300, "edt": -240, "aest": 600, "aedt": 660}

_INSTANTS = r"""
texts as (
  select 'feed_items' as table_name, feed_row_no as row_no, unnest(['uploaded_date', 'manual_date', 'authorized_date']) as field_name, unnest([uploaded_date, manual_date, authorized_date]) as text, null as hint from feed_items
  union all select 'source_instants', instant_id, 'raw', raw, zone_hint from source_instants
),
plain as (select *, lower(regexp_replace(text, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')) as s from texts),
zoned as (select *, regexp_extract(s, '^(.*(?::[0-9]{2}(?:\.[0-9]+)?(?: [ap]m)?|[a-z]{3}[0-9]{10})) ?(z|[a-z]{3,4}|(?:utc|gmt)?[+-][0-9]{1,2}(?::?[0-9]{2})?)$', ['base', 'zone']) as p from plain),
parts as (select *, coalesce(nullif(p.base, ''), s) as base, nullif(p.zone, '') as zone from zoned),
read as (select *, try_strptime(base, [{forms}]) as local, regexp_extract(zone, '([+-])([0-9]{1,2}):?([0-9]{2})?$', ['sign', 'h', 'm']) as o from parts),
placed as (select *, coalesce(nullif(trim(hint), ''), 'Asia/Colombo') as tz, case zone {named} else case when o.h <> '' then (case o.sign when '-' then -1 else 1 end) * (try_cast(o.h as int) * 60 + coalesce(try_cast(o.m as int), 0)) end end as off from read),
met as (select *, local at time zone tz as at_tz from placed),
utc as (select *, case
    when regexp_full_match(s, '-?[0-9]+(\.0+)?') and not regexp_full_match(s, '[0-9]{14}') then (case when abs(n) < 100000000000 then n * 1000000 when abs(n) < 100000000000000 then n * 1000 else n end)
    when zone is not null then epoch_us(local) - off::bigint * 60000000
    -- A reading that its zone never shows, or shows an hour apart as well, is none.
    when (at_tz at time zone tz) = local and ((at_tz - interval 1 hour) at time zone tz) <> local and ((at_tz + interval 1 hour) at time zone tz) <> local then epoch_us(at_tz)
  end as utc_us from (select *, try_cast(regexp_extract(s, '^(-?[0-9]+)(\.0+)?$', 1) as bigint) as n from met))
select table_name, row_no, field_name, utc_us from utc where utc_us is not null and not (field_name = 'manual_date' and (utc_us = -19800000000 or s in ('-19800', '-19800.0', '-19800000', '-19800000.0')))""".replace(
    "{forms}", ", ".join(f"'{f}'" for f in _FORMS)
).replace("{named}", " ".join(f"when '{k}' then {v}" for k, v in _NAMED.items()))

# Amounts: look-around is written as a neighbouring character, and every distinct text is read once.
_SCRIPT = r"\x{0300}-\x{036F}\x{0B80}-\x{0BFF}\x{0D80}-\x{0DFF}"
_BEFORE, _AFTER = rf"(?:^|[^\p{{L}}{_SCRIPT}])", rf"(?:$|[^\p{{L}}\p{{N}}{_SCRIPT}])"
_UNITS, _MONEYS = "|".join(p for p, _ in money.UNIT_WORDS), "|".join(p for p, _ in money.CURRENCY_WORDS)
_LIKE = "".join(chr(c) for c in money.ALIKE), "".join(v for v in money.ALIKE.values())


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain(text: str) -> str:
    return f"trim(regexp_replace(translate(lower({text}), {_quoted(_LIKE[0])}, {_quoted(_LIKE[1])}), '\\s+', ' ', 'g'))"


def _first(words, test) -> str:
    return "case " + " ".join(f"when {test(p)} then {v if isinstance(v, int) else _quoted(v)}" for p, v in words) + " end"


def _said(t: str) -> tuple[str, str]:
    """What a running text states: its unit (not one that follows a number's own digits) and its currency."""
    guard = lambda p: f"(?:^|[^\\p{{L}}{_SCRIPT}0-9.,])" if p == money.UNIT_WORDS[0][0] else _BEFORE
    return tuple(_first(words, lambda p: f"regexp_matches({t}, {_quoted(guard(p) + '(?:' + p + ')' + _AFTER)})") for words in (money.UNIT_WORDS, money.CURRENCY_WORDS))


def _whole(t: str, words) -> str:
    return _first(words, lambda p: f"regexp_full_match({t}, {_quoted(p)})")


_AMOUNT = rf"^(?P<ca>{_MONEYS})?\s*(?P<ua>{_UNITS.split('|', 1)[1]})?\s*(?P<minus>-?)\s*(?P<n>[0-9](?:[0-9.,' ]*[0-9])?)\s*(?P<ub>{_UNITS})?\s*(?P<cb>{_MONEYS})?\s*(?P<uc>{_UNITS})?$"

_HEADINGS = f"""said as (select text, u, c from (select text, {_said("t")[0]} as u, {_said("t")[1]} as c from (select text, {_plain("text")} as t from (select label_raw as text from v union select currency from v union select unnest(string_split(scale_evidence, ' | ')) from v) where text is not null))),
stated as (select text, coalesce(u, case when c is not null then 10000 end) as unit, c as code from said),
heads as (select scale_evidence, case when count(distinct unit) = 1 then min(unit) end as unit, case when count(distinct code) = 1 then min(code) end as code from (select distinct scale_evidence, unnest(string_split(scale_evidence, ' | ')) as text from v) join stated using (text) group by all)"""

_AMOUNTS = f"""
v as (select distinct value_id, raw_value, label_raw, reported_scale, scale_evidence, currency, printed_decimals from reported_values),
raws as (select distinct raw_value, printed_decimals from v where raw_value is not null),
r1 as (select *, {_plain("raw_value")} as s from raws),
r2 as (select *, starts_with(s, '(') and ends_with(s, ')') as paren, case when starts_with(s, '(') and ends_with(s, ')') then trim(s[2:-2]) else s end as inner_s from r1),
r3 as (select *, starts_with(inner_s, '-') or ends_with(inner_s, '-') as signed, case when starts_with(inner_s, '-') then ltrim(inner_s[2:]) when ends_with(inner_s, '-') then rtrim(inner_s[1:-2]) else inner_s end as t from r2),
r4 as (select *, regexp_extract(t, {_quoted(_AMOUNT)}, ['ca', 'ua', 'minus', 'n', 'ub', 'cb', 'uc']) as m from r3),
r5 as (select *, translate(m.n, ' ' || chr(39), '') as d from r4 where m.n <> ''),
r6 as (select *, length(d) - length(replace(d, '.', '')) as dots, length(d) - length(replace(d, ',', '')) as commas, strpos(reverse(d), '.') as dot_end, strpos(reverse(d), ',') as comma_end from r5),
r7 as (select *, case when dots > 0 and commas > 0 then case when dot_end < comma_end then replace(d, ',', '') else replace(replace(d, '.', ''), ',', '.') end
  when commas > 0 then case when commas > 1 or comma_end = 4 then replace(d, ',', '') else replace(d, ',', '.') end when dots > 1 or (dots = 1 and printed_decimals = 0 and dot_end = 4) then replace(d, '.', '') else d end as plain from r6),
amounts as (select raw_value, printed_decimals, (try_cast(plain as decimal(38,6)) * case when paren or signed or m.minus = '-' then -1 else 1 end) as number,
  coalesce({_whole("nullif(m.ub, '')", money.UNIT_WORDS)}, {_whole("nullif(m.uc, '')", money.UNIT_WORDS)}, {_whole("nullif(m.ua, '')", money.UNIT_WORDS)}) as unit, coalesce({_whole("nullif(m.ca, '')", money.CURRENCY_WORDS)}, {_whole("nullif(m.cb, '')", money.CURRENCY_WORDS)}) as code from r7),
{_HEADINGS},
j as (select v.value_id, a.number, coalesce(a.unit, l.unit, case when v.reported_scale > 0 then v.reported_scale * 10000 end, h.unit) as unit, coalesce(a.code, l.code, c.code, h.code) as code
  from v join amounts a on a.raw_value = v.raw_value and a.printed_decimals is not distinct from v.printed_decimals left join stated l on l.text = v.label_raw left join stated c on c.text = v.currency left join heads h on h.scale_evidence = v.scale_evidence where a.number is not null),
e as (select value_id, code, abs(number * 1000000)::hugeint * unit::hugeint as big, number < 0 as neg from j where unit is not null and code is not null)
select distinct value_id, code as currency_code, ((case when neg then -1 else 1 end) * ((big + 500000) // 1000000))::bigint as amount_e4 from e where (big + 500000) // 1000000 < 9223372036854775807::hugeint"""

_PAIRS = f"""
rows as (select distinct snapshot_no, cse_filing_id, {_content("raw_item")} as content from listing_snapshots),
numbers as (select snapshot_no, lag(snapshot_no) over (order by snapshot_no) as before from (select distinct snapshot_no from rows)),
pairs as (
  select n.snapshot_no, coalesce(a.cse_filing_id, b.cse_filing_id) as cse_filing_id, a.content as new_content, b.content as old_content
  from numbers n join rows a on a.snapshot_no = n.snapshot_no left join rows b on b.snapshot_no = n.before and b.cse_filing_id = a.cse_filing_id where n.before is not null
  union all
  select n.snapshot_no, b.cse_filing_id, null, b.content from numbers n join rows b on b.snapshot_no = n.before
  where not exists (select 1 from rows a where a.snapshot_no = n.snapshot_no and a.cse_filing_id = b.cse_filing_id)
)"""

SQL = {
    "p3_values": "with " + _PAIRS.replace(_content("raw_item"), _canonical("raw_item")) + " select snapshot_no::int as snapshot_no, cse_filing_id, case when old_content is null then 'added' when new_content is null then 'removed' else 'changed' end as change_kind, old_content as value_before, new_content as value_after from pairs where new_content is distinct from old_content",
    "p4_found": "with " + _AMOUNTS,
    "p6_found": "with " + _INSTANTS,
    "p1_found": "with " + _CHILD + " select table_name, row_key, month_utc, kind from failed where kind is not null",
    "p1_counts": "with " + _CHILD + " select table_name, month_utc, kind, count(*) as n_references from failed where kind is not null group by all",
    "p2_found": _COMPANIES + """,
blocks as (select raw_id, company_no, b.block_name, b.key_name, json_extract(c, '$.' || b.block_name) as v from companies, (values ('reqSymbolInfo', 'symbol'), ('reqSymbolBetaInfo', 'securityId'), ('reqLogo', 'secId')) b(block_name, key_name)),
items as (
  select raw_id, company_no, block_name, key_name, i::varchar as item_path, json_extract(v, '$[' || i || ']') as o from (select *, unnest(range(json_array_length(v)::bigint)) as i from blocks where json_type(v) = 'ARRAY')
  union all select raw_id, company_no, block_name, key_name, '0', v from blocks where json_type(v) = 'OBJECT'
),
owners as (select raw_id, company_no, block_name, item_path, o, coalesce(json_extract_string(o, '$.' || key_name), '') as key_value from items where json_type(o) = 'OBJECT'),
inner_lists as (select *, json_extract(o, '$.' || f) as v from owners, (select unnest(['tradeWindows', 'history', 'versions']) as f)),
inner_items as (select raw_id, company_no, block_name, item_path || '.' || i as item_path, json_extract(v, '$[' || i || ']') as o, key_value from (select *, unnest(range(json_array_length(v)::bigint)) as i from inner_lists where json_type(v) = 'ARRAY'))
select raw_id, company_no, block_name, item_path, key_value from owners union all select raw_id, company_no, block_name, item_path, key_value from inner_items where json_type(o) = 'OBJECT'""",
    "p2_places": _COMPANIES + r""",
found as (select raw_id, company_no, t.fullkey as k from companies, json_tree(c) t where json_type(c) = 'OBJECT' and t.type = 'OBJECT')
select raw_id, company_no, regexp_replace(k, '\.([A-Za-z0-9_]+)', '["\1"]', 'g') as path, (length(k) - length(replace(k, '.', '')))::int as depth, nullif(regexp_extract(k, '\.([A-Za-z0-9_]+)(?:\[[0-9]+\])*$', 1), '') as field_name from found""",
    "p3_found": "with " + _PAIRS + " select snapshot_no::int as snapshot_no, cse_filing_id, case when old_content is null then 'added' when new_content is null then 'removed' else 'changed' end as change_kind from pairs where new_content is distinct from old_content",
    "p5_found": "with " + _OBSERVED + """
select 'filing_observations' as table_name, delivery_no from ranked where rn > 1
union all
select 'filings', delivery_no from (select delivery_no, row_number() over (partition by cse_filing_id order by delivery_no) as rn from filings where cse_filing_id is not null) where rn > 1""",
    "p7_known": _KNOWN,
    "p7_found": _KNOWN + " where decision_id is distinct from final_decision or delivery_no is distinct from final_delivery",
}
