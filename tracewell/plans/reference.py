"""Queries of the reference's data-processing operators over the shared tables, each with its SQL.

A query's name starts with the inventory number of its operator.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.functions import listing
from tracewell.operators import evidence, ordered
from tracewell.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Fixed values of the adapter: which source is preferred, and what is stated at the end of a day.
PRECEDENCE = ("purchase", "click", "view", "signup", "error")
END_OF_DAY = ("price",)


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Events as observations: two fields per (entity, day, source, window)."""
    e = table(spark, d, "events").select("event_id", F.col("user_id").alias("entity"), F.to_date("ts").alias("day"), F.col("event_type").alias("source"), "ts", F.col("value").cast("decimal(18,2)").alias("price"), F.get_json_object("props", "$.k").cast("decimal(18,2)").alias("volume"))
    fields = F.array(F.struct(F.lit("price").alias("field"), F.lit("pct").alias("tolerance"), F.col("price").alias("value")), F.struct(F.lit("volume").alias("field"), F.lit("exact").alias("tolerance"), F.col("volume").alias("value")))
    window = F.when(F.hour("ts") < 12, "post_open").otherwise("post_close")
    return e.select("entity", "day", "source", window.alias("capture_window"), F.col("ts").alias("observed_at"), F.col("event_id").alias("obs_id"), F.inline(fields))


_RANK = "case source " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(PRECEDENCE)) + f" else {len(PRECEDENCE)} end"
_OBS = f"""
obs as (
  select user_id as entity, ts::date as day, event_type as source, case when hour(ts) < 12 then 'post_open' else 'post_close' end as win, ts, event_id, u.field, u.value, u.tol from events,
    lateral (select 'price' as field, events.value::decimal(18,2) as value, 'pct' as tol union all select 'volume', (json_extract_string(events.props, '$.k'))::decimal(18,2), 'exact') u
),
used as (select *, not (field = 'price' and win = 'post_open') as use_it from obs where value is not null),
ranked as (select *, row_number() over w as n, first_value(source) over w as ws, first_value(win) over w as ww, first_value(value) over w as wv from used
  window w as (partition by entity, day, field order by use_it desc, {_RANK}, ts desc, event_id)),
marked as (select *, case when tol = 'exact' then wv = value when wv = 0 and value = 0 then true else abs(wv - value)::double / greatest(abs(wv)::double, abs(value)::double, 1e-9) * 100 <= 0.1 end as same,
  use_it and n > 1 and source = ws and (win <> ww or win = 'post_open') as moving, use_it and n > 1 as other from ranked),
fields as (select entity, day, field, max(value) filter (where n = 1 and use_it) as value, max(source) filter (where n = 1 and use_it) as source, count(*) filter (where use_it) as n_candidates,
  count(*) filter (where moving and not same) as n_superseded, count(*) filter (where other and not moving) as c, count(*) filter (where other and not moving and not same) as bad from marked group by all)"""


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return evidence.reconcile_fields(observations(spark, d), ["entity", "day"], PRECEDENCE, END_OF_DAY)


@_query("with " + _OBS + """
select entity, day, max(value) filter (where field = 'price') as price, max(value) filter (where field = 'volume') as volume, count(distinct source) filter (where value is not null) as n_sources,
  sum(case when bad > 0 then c else 0 end)::bigint as n_alternates, sum(n_superseded)::bigint as n_superseded,
  case when count(*) filter (where bad > 0) > 0 then 'discrepancy_flagged' when count(*) filter (where field = 'price' and value is not null) = 0 then 'pending'
    when count(distinct source) filter (where value is not null) <= 1 then 'single_source' else 'agreed' end as status
from fields group by all""")  # fmt: skip
def d1_field_reconciliation(spark, d):
    return evidence.canonical_rows(_fields(spark, d), ["entity", "day"], ["price", "volume"], END_OF_DAY)


@_query("with " + _OBS + """
select entity, day, field, value, source, n_candidates, n_superseded, case when bad > 0 then c else 0 end as n_alternates,
  case when n_candidates = 0 then 'not_yet_available' when bad > 0 then 'discrepancy' else 'settled' end as state from fields""")  # fmt: skip
def d1_field_provenance(spark, d):
    return _fields(spark, d)


@_query("with " + _OBS + """, n as (select entity, day, source, count(*) as k, min(field) as first_field from fields where value is not null group by all)
select entity, day, arg_min(source, (-k, first_field)) as primary_source from n group by all""")  # fmt: skip
def a7_primary_source(spark, d):
    n = _fields(spark, d).where(F.col("value").isNotNull()).groupBy("entity", "day", "source").agg(F.count(F.lit(1)).alias("k"), F.min("field").alias("f"))
    return n.groupBy("entity", "day").agg(F.min_by("source", F.struct(-F.col("k"), "f")).alias("primary_source"))


_MEMBERS = """
members as (select l_orderkey as fact, l_suppkey as document, l_extendedprice::decimal(18,2) as v, ((l_quantity::int % 5) * 4000 + 10)::decimal(18,2) as h, l_linenumber as ord, l_partkey as part, l_shipdate as known_at from lineitem)"""
_FACTS = """
docs as (select fact, document, max(v - h) as lo, min(v + h) as hi, count(*) as n from {0} group by all),
tot as (select fact, max(lo) as low, min(hi) as high, sum(n)::bigint as n_members, count(*) as n_documents, bool_or(lo > hi) as inside from docs group by all),
vals as (select fact, min(v) as mn, max(v) as mx, min(h) as mh, arg_min(v, (h, document, ord, part, v)) as rep from {0} group by all),
amb as (select m.fact, count(distinct m.v) as k from {0} m join vals v on v.fact = m.fact and m.h = v.mh group by all)
select t.fact, case when low > high then 'conflicting' when n_documents = 1 then 'single_source' else 'corroborated' end as state, n_documents, n_members,
  case when low <= high then low end as low, case when low <= high then high end as high, case when low <= high and k = 1 then rep end as representative,
  concat_ws(',', case when low <= high and mn <> mx then 'agreement_within_precision_only' end, case when inside then 'internal_conflict' end, case when low <= high and k > 1 then 'representative_ambiguous' end) as annotations
from tot t join vals v on v.fact = t.fact join amb a on a.fact = t.fact"""


def members(spark: SparkSession, d: str) -> DataFrame:
    """Line items as printed values of a fact (order) in documents (suppliers)."""
    q = F.col("l_quantity").cast("int")
    half = ((q % 5) * 4000 + 10).cast("decimal(18,2)")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("fact"), F.col("l_suppkey").alias("document"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v"), half.alias("h"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("known_at"))


def _facts(rows: DataFrame) -> DataFrame:
    return evidence.reconcile_facts(rows, "fact", "document", "v", "h", ["document", "ord", "part"])


@_query("with " + _MEMBERS + "," + _FACTS.format("members"))
def d18_fact_reconciliation(spark, d):
    return _facts(members(spark, d))


_PIT = _MEMBERS + """,
seen as (select m.*, o.o_orderdate as available_at from members m left join orders o on o.o_orderkey = m.fact),
visible as (select * from seen where {0})"""
_T, _H = "1998-06-01", "1999-03-01"


def _seen(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("fact"), F.col("o_orderdate").alias("available_at"))
    return members(spark, d).join(o, "fact", "left")


def _as_of(mode: str, cond: str):
    sql = "with " + _PIT.format(cond) + "," + _FACTS.format("visible")

    def query(spark: SparkSession, d: str) -> DataFrame:
        at = F.lit(_T).cast("timestamp") if mode != "current" else None
        horizon = F.lit(_H).cast("timestamp") if mode in ("available", "current") else None
        return _facts(evidence.visible_evidence(_seen(spark, d), mode, "available_at", "known_at", at, horizon))

    query.__name__ = f"d24_as_of_{mode}"
    _query(sql)(query)


_as_of("known", f"known_at <= timestamp '{_T}' and (available_at is null or available_at <= timestamp '{_T}')")
_as_of("available", f"known_at <= timestamp '{_H}' and available_at <= timestamp '{_T}'")
_as_of("current", f"known_at <= timestamp '{_H}'")
_as_of("recorded", f"known_at <= timestamp '{_T}'")

_CUTOFFS = [f"{y}-01-01" for y in range(1995, 2003)]


@_query("with " + _MEMBERS + ", cutoffs as (select unnest([" + ", ".join(f"timestamp '{c}'" for c in _CUTOFFS) + """]) as cutoff)
select cutoff::date as cutoff, count(distinct fact) as n_facts, count(fact) as n_members, sum(v) as total from cutoffs left join members on known_at <= cutoff group by all""")  # fmt: skip
def d25_timeline(spark, d):
    # Each member enters at its first cutoff; a running sum over cutoffs replaces the range join.
    cuts = F.array(*[F.lit(c).cast("timestamp") for c in _CUTOFFS])
    m = members(spark, d).select("fact", "v", F.array_min(F.filter(cuts, lambda c: c >= F.col("known_at"))).alias("cutoff")).where(F.col("cutoff").isNotNull())
    new_facts = m.groupBy("fact").agg(F.min("cutoff").alias("cutoff")).groupBy("cutoff").agg(F.count(F.lit(1)).alias("f"))
    sums = m.groupBy("cutoff").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    every = spark.range(1).select(F.explode(cuts).alias("cutoff"))
    w = Window.orderBy("cutoff").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    j = every.join(sums, "cutoff", "left").join(new_facts, "cutoff", "left")
    return j.select(F.to_date("cutoff").alias("cutoff"), F.coalesce(F.sum("f").over(w), zero).alias("n_facts"), F.coalesce(F.sum("n").over(w), zero).alias("n_members"), F.sum("s").over(w).alias("total"))


@_query("""select event_id, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1""")
def w1_latest_per_key(spark, d):
    return ordered.latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "event_type", "value")


@_query("""select event_id, user_id, row_number() over w as sequence, lag(event_type) over w as previous_event_type from events window w as (partition by user_id order by ts, event_id)""")
def w7_append_chain(spark, d):
    return ordered.append_chain(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "sequence", "previous_event_type")


@_query("""select event_id, changes from (select event_id, concat_ws(',', case when rn > 1 and event_type is distinct from pt then 'event_type_changed' end, case when value > pv then 'value_increased' end) as changes
from (select *, row_number() over w as rn, lag(event_type) over w as pt, lag(value) over w as pv from events window w as (partition by user_id order by ts, event_id))) where changes <> ''""")  # fmt: skip
def w3_change_events(spark, d):
    return ordered.change_events(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type"], ["value"]).select("event_id", "changes")


@_query("""select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as previous_purchase from events""")
def j7_previous_value(spark, d):
    e = table(spark, d, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")))
    return ordered.previous_value(e, ["user_id"], ["ts", "event_id"], "p", "previous_purchase").select("event_id", "previous_purchase")


@_query("""with s as (select l_orderkey, l_linenumber - 1 as ord, l_shipdate, row_number() over w as rn, lag(l_shipdate) over w as ps from lineitem window w as (partition by l_orderkey order by l_linenumber, l_shipdate, l_partkey))
select l_orderkey, count(*) filter (where rn > 1 and not ps < l_shipdate) as n_not_increasing, (max(ord) = count(*) - 1 and min(ord) = 0 and count(distinct ord) = count(*)) as gapless from s group by all""")  # fmt: skip
def w11_order_violations(spark, d):
    rows = table(spark, d, "lineitem").withColumn("ord", F.col("l_linenumber") - 1)
    return ordered.order_violations(rows, ["l_orderkey"], "ord", ["l_shipdate"])


@_query("""with m as (select distinct o_custkey, year(o_orderdate) * 12 + month(o_orderdate) as m from orders), g as (select o_custkey, m - lag(m) over (partition by o_custkey order by m) as gap from m),
c as (select o_custkey, gap, count(*) as n from g where gap is not null group by all)
select o_custkey, sum(n)::bigint as n_gaps, arg_min(gap, (-n, gap)) as cadence_months from c group by all having sum(n) >= 2""")  # fmt: skip
def a13_cadence(spark, d):
    return ordered.cadence(table(spark, d, "orders"), ["o_custkey"], F.year("o_orderdate") * 12 + F.month("o_orderdate"))


@_query("select c_custkey, c_name from customer order by sha256('2024-01-05|' || c_custkey), c_custkey limit 25")
def t1_rotating_sample(spark, d):
    return ordered.rotating_sample(table(spark, d, "customer"), "2024-01-05", "c_custkey", 25).select("c_custkey", "c_name")


@_query("""select c_custkey, c_mktsegment, round from (select *, row_number() over (partition by c_mktsegment, c_nationkey order by sha256('s1|' || c_custkey), c_custkey) as round from customer) order by round, c_mktsegment, c_nationkey limit 60""")
def t2_stratified_sample(spark, d):
    return ordered.stratified_sample(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"], "s1", "c_custkey", 60).select("c_custkey", "c_mktsegment", "round")


# Every table whose values two engines print alike (not the vectors).
_DIGESTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "issuers", "filings", "filing_observations", "classifications", "issuer_decisions", "extraction_runs", "knowledge_views", "reported_values", "listing_snapshots", "company_info_raw", "documents")
_DOUBLES = {"customer": ["c_acctbal"], "supplier": ["s_acctbal"], "part": ["p_retailprice"], "orders": ["o_totalprice"], "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "reported_values": ["parsed_value"]}
_INSTANTS = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "issuers": ["created_at", "retired_at"], "filings": ["uploaded_at", "authorized_at", "first_seen_at", "last_seen_at"], "filing_observations": ["observed_at"], "classifications": ["classified_at"], "issuer_decisions": ["decided_at"], "extraction_runs": ["recorded_at", "cdn_last_modified", "path_epoch_at", "document_retrieved_at"], "knowledge_views": ["known_at"], "listing_snapshots": ["taken_at"], "company_info_raw": ["observed_at"], "documents": ["received_at"]}
_LISTS = {"filings": ["listing_symbols", "source_buckets"]}


def _digest_sql(table_name: str) -> str:
    framed = lambda t: f"coalesce(length({t}) || ':' || {t}, '-')"
    change = [f"case when try_cast({c}::varchar as decimal(30,8)) = try_cast({c}::varchar as decimal(38,16)) then {c}::varchar::decimal(30,8)::varchar else {c}::varchar end as {c}" for c in _DOUBLES.get(table_name, [])]
    change += [f"epoch_us({c})::varchar as {c}" for c in _INSTANTS.get(table_name, [])]
    change += [f"array_to_string(list_transform({c}, lambda x: {framed('x')}), '') as {c}" for c in _LISTS.get(table_name, [])]
    rows = f"select * replace ({', '.join(change)}) from {table_name}" if change else f"select * from {table_name}"
    limbs = ", ".join(f"coalesce(sum(('0x' || substr(h, {1 + 8 * i}, 8))::bigint), 0)::decimal(38,0) as limb_{i}" for i in range(8))
    texts = "select coalesce(length(columns(*)::varchar) || ':' || columns(*)::varchar, '-') from (" + rows + ")"
    return f"select '{table_name}' as table_name, count(*) as n_rows, {limbs} from (select sha256(concat(*columns(*))) as h from ({texts}))"


@_query(" union all ".join(map(_digest_sql, _DIGESTED)))
def k9_table_digest(spark, d):
    out = [ordered.table_digest(table(spark, d, t)).select(F.lit(t).alias("table_name"), "*") for t in _DIGESTED]
    return functools.reduce(DataFrame.unionByName, out)


_LEGAL = [("view", "click"), ("click", "purchase"), ("signup", "view"), ("view", "view"), ("click", "view"), ("purchase", "view")]


@_query("""with s as (select lag(event_type) over (partition by user_id order by ts, event_id) as from_state, event_type as to_state from events)
select from_state, to_state, count(*) as n_steps from s where from_state is not null and (from_state, to_state) not in (""" + ", ".join(map(str, _LEGAL)) + ") group by all")  # fmt: skip
def d30_illegal_transitions(spark, d):
    legal = spark.createDataFrame(_LEGAL, "from_state string, to_state string")
    return ordered.illegal_transitions(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type", legal)


@_query("""select o_orderkey, check_name from (select o_orderkey, unnest([case when not o_totalprice >= 100000 then 'price_floor' end, case when not o_orderstatus in ('F','O') then 'status_domain' end, case when not o_orderdate < timestamp '2001-01-01' then 'date_bound' end]) as check_name from orders) where check_name is not null""")
def f15_constraint_violations(spark, d):
    checks = {"price_floor": F.col("o_totalprice") >= 100000, "status_domain": F.col("o_orderstatus").isin("F", "O"), "date_bound": F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp")}
    return ordered.constraint_violations(table(spark, d, "orders"), "o_orderkey", checks)


# Sources in order of precedence; others come after them, in order of their names.
ENDPOINT_ORDER = ("financials", "getfinancialannouncement")
BUCKET_ORDER = ("annual", "quarterly", "other", "web_link", "none")
# The listing fields that are merged, and those that are instants.
MERGED = ("path", "path2", "manualDate", "uploadedDate", "authorizedDate", "fileText", "name", "symbol")
MERGED_INSTANTS = ("uploadedDate", "authorizedDate")

_SOURCES = """
named as (select *, regexp_replace(lower(trim(source_endpoint)), '^/api/', '') as ep, coalesce(nullif(regexp_replace(lower(trim(source_bucket)), '^/api/', ''), ''), 'none') as raw_bk, coalesce(query_symbol, '') as qs from filing_observations),
sources as (select * exclude (raw_bk), case raw_bk when 'infoannualdata' then 'annual' when 'infoquarterlydata' then 'quarterly' when 'infootherdata' then 'other' when 'infoweblink' then 'web_link' else raw_bk end as bk,
  concat_ws('~', """ + ", ".join(f"coalesce(json_extract(raw_item::json, '$.{k}')::varchar, '-')" for k in ("authorizedDate", "fileText", "id", "manualDate", "name", "path", "path2", "symbol", "uploadedDate")) + """) as content from named),
cur as (select * from (select *, row_number() over (partition by cse_filing_id, ep, bk, qs order by observed_at desc, delivery_no desc) as rn from sources) where rn = 1),
placed as (select *, row_number() over (partition by cse_filing_id order by """ + " ".join(["case ep", *[f"when '{e}' then {i}" for i, e in enumerate(ENDPOINT_ORDER)], "else 9 end, ep,", "case bk", *[f"when '{b}' then {i}" for i, b in enumerate(BUCKET_ORDER)], "else 9 end, bk, qs"]) + """) as place from cur)"""


def _instant_sql(text: str) -> str:
    return f"case when regexp_full_match({text}, '-?[0-9]+') then {text}::bigint * 1000 else epoch_us(try_strptime({text}, '%d %b %Y %I:%M:%S %p') - interval 330 minute) end"


def _merged_sql(f: str) -> str:
    """Provider and differences of one field: the first source that has the key, its null counting as a value."""
    text = f"json_extract_string(raw_item::json, '$.{f}')"
    value = _instant_sql(text) if f in MERGED_INSTANTS else text
    apart = f"abs(p.v - f.v) >= 1000000 or (p.v is null) <> (f.v is null)" if f in MERGED_INSTANTS else "p.v is distinct from f.v"
    return f"""p_{f} as (select cse_filing_id, place, {value} as v from placed where list_contains(json_keys(raw_item::json), '{f}')),
f_{f} as (select * from p_{f} qualify row_number() over (partition by cse_filing_id order by place) = 1),
m_{f} as (select f.cse_filing_id, any_value(f.v) as v, count(*) filter (where {apart}) as n from f_{f} f join p_{f} p using (cse_filing_id) group by all)"""


@_query("with " + _SOURCES + ", " + ", ".join(map(_merged_sql, MERGED)) + " select k.cse_filing_id, k.n_sources, " + ", ".join(f'm_{f}.v as "{f}"' for f in MERGED) + ", " + " + ".join(f"coalesce(m_{f}.n, 0)" for f in MERGED) + " as n_differences from (select cse_filing_id, count(*) as n_sources from cur group by all) k " + " ".join(f"left join m_{f} on m_{f}.cse_filing_id = k.cse_filing_id" for f in MERGED))
def d5_listing_merge(spark, d):
    cur = current_versions(table(spark, d, "filing_observations"))
    item = F.from_json("raw_item", "map<string,string>")
    cur = cur.withColumn("item", F.transform_values(item, lambda k, v: F.when(k.isin(*MERGED_INSTANTS), listing.instant_micros(v).cast("string")).otherwise(v)))
    out = evidence.merge_listing_fields(cur, "cse_filing_id", MERGED, source_precedence(), {f: 1_000_000 for f in MERGED_INSTANTS})
    return out.withColumns({f: F.col(f).cast("long") for f in MERGED_INSTANTS})


def current_versions(observed: DataFrame) -> DataFrame:
    """Observations with their source (ep, bk, qs) under its plain name, the latest of each filing's source."""
    rows = observed.withColumns({"ep": listing.endpoint_name("source_endpoint"), "bk": listing.bucket_name("source_bucket"), "qs": F.coalesce("query_symbol", F.lit(""))})
    return ordered.latest_per_key(rows, ["cse_filing_id", "ep", "bk", "qs"], [F.desc("observed_at"), F.desc("delivery_no")])


def source_precedence() -> list:
    """Sort columns over (ep, bk, qs)."""
    rank = lambda c, names: F.coalesce(*[F.when(F.col(c) == n, F.lit(i)) for i, n in enumerate(names)], F.lit(9))
    return [rank("ep", ENDPOINT_ORDER).alias("o1"), F.coalesce("ep", F.lit("")).alias("o2"), rank("bk", BUCKET_ORDER).alias("o3"), F.col("bk").alias("o4"), F.col("qs").alias("o5")]
