"""Further queries of the reference's operators: sources, joins, aggregates, sets, scalars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.functions import keys, listing, texts
from tracewell.operators import ordered, ranges
from tracewell.plans.reference import _MEMBERS, QUERIES, SQL, _query, members
from tracewell.sources import listings
from tracewell.sources.tables import table

__all__ = ["QUERIES", "SQL"]


@_query("""select delivery_no, json_extract_string(raw_item::json, '$.id')::bigint as item_id, json_extract_string(raw_item::json, '$.path') as path, json_extract_string(raw_item::json, '$.fileText') as file_text,
  json_extract_string(raw_item::json, '$.manualDate')::bigint as manual_date, json_extract_string(raw_item::json, '$.uploadedDate') as uploaded from filing_observations""")  # fmt: skip
def s7_listing_items(spark, d):
    return listings.parse_items(table(spark, d, "filing_observations"), "raw_item").select("delivery_no", "item_id", "path", "file_text", "manual_date", "uploaded")


@_query("""with e as (select snapshot_no, row_number() over (partition by snapshot_no order by taken_at, cse_filing_id, query_symbol nulls first, source_bucket nulls first, raw_item) - 1 as place, coalesce(nullif(json_extract_string(raw_item::json, '$.symbol'), ''), nullif(json_extract_string(raw_item::json, '$.Symbol'), ''), nullif(json_extract_string(raw_item::json, '$.securityCode'), '')) as symbol from listing_snapshots)
select snapshot_no, symbol, min(place) as first_place, count(*) as n_seen from e where symbol is not null group by all""")  # fmt: skip
def s5_universe_entries(spark, d):
    """Symbols of a payload in its order: the place of each one's first entry, and how often it comes."""
    rows = table(spark, d, "listing_snapshots").select("snapshot_no", "taken_at", "cse_filing_id", "query_symbol", "source_bucket", "raw_item")
    v = F.try_parse_json("raw_item")
    symbol = F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in ("symbol", "Symbol", "securityCode")])
    placed = ordered.with_previous(rows, ["snapshot_no"], ["taken_at", "cse_filing_id", "query_symbol", "source_bucket", "raw_item"]).select("snapshot_no", (F.col("_seq") - 1).alias("place"), symbol.alias("symbol"))
    return placed.where(F.col("symbol").isNotNull()).groupBy("snapshot_no", "symbol").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n_seen"))


@_query("select o_orderkey, o_totalprice from orders where o_orderkey not in (select o_orderkey from orders where o_orderdate < timestamp '1997-01-01')")
def k1_idempotent_append(spark, d):
    held = table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp"))
    return ordered.rows_to_append(held, table(spark, d, "orders"), ["o_orderkey"], [F.col("o_orderdate"), F.col("o_totalprice")]).select("o_orderkey", "o_totalprice")


@_query("select user_id, arg_max(event_type, (ts, -event_id)) as state, max(ts) as checked_at from events group by all")
def k3_forward_only_state(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", -F.col("event_id"))).alias("state"), F.max("ts").alias("checked_at"))


@_query("""with j as (select delivery_no, raw_item::json as j, json_keys(raw_item::json) as k from filing_observations)
select delivery_no, case when list_contains(k, 'path2') then json_extract_string(j, '$.path2') when list_contains(k, 'path') then json_extract_string(j, '$.path') end as path, case when list_contains(k, 'path2') then 'path2' when list_contains(k, 'path') then 'path' end as found_as,
 list_contains(k, 'path2') and list_contains(k, 'path') as several, list_contains(k, 'path2') and list_contains(k, 'path') and json_extract_string(j, '$.path2') is distinct from json_extract_string(j, '$.path') as disagree from j""")  # fmt: skip
def f1_first_present_name(spark, d):
    rows = table(spark, d, "filing_observations").withColumn("item", F.from_json("raw_item", "map<string,string>"))
    return listings.first_present(rows, "item", ["path2", "path"], "path").select("delivery_no", "path", "found_as", "several", "disagree")


@_query("""select k.fact, coalesce(m.n, 0) as n_members, case when m.n is null then 'none' else 'present' end as state from (select unnest([1, 2, 3, 7, 32, 1000000001]::bigint[]) as fact) k left join (select l_orderkey as fact, count(*) as n from lineitem group by all) m using (fact)""")
def f9_fact_filter_padded(spark, d):
    wanted = [1, 2, 3, 7, 32, 1_000_000_001]
    got = table(spark, d, "lineitem").where(F.col("l_orderkey").isin(wanted)).groupBy(F.col("l_orderkey").alias("fact")).agg(F.count(F.lit(1)).alias("n"))
    asked = spark.createDataFrame([(k,) for k in wanted], "fact long")
    return asked.join(got, "fact", "left").select("fact", F.coalesce("n", F.lit(0).cast("long")).alias("n_members"), F.when(F.col("n").isNull(), "none").otherwise("present").alias("state"))


@_query("select count(*) filter (where path is not distinct from path2) as n_same, count(*) filter (where path = path2) as n_equal, count(*) as n_rows from filings")
def f13_null_safe_equality(spark, d):
    return table(spark, d, "filings").agg(F.count_if(F.col("path").eqNullSafe(F.col("path2"))).alias("n_same"), F.count_if(F.col("path") == F.col("path2")).alias("n_equal"), F.count(F.lit(1)).alias("n_rows"))


@_query("""select f.delivery_no, x.id as decision_id, x.status from filings f left join (select * from (select distinct id, cse_filing_id, status, row_number() over (partition by cse_filing_id order by id desc) as rn from issuer_decisions) where rn = 1) x on x.cse_filing_id = f.cse_filing_id""")
def j5_latest_decision(spark, d):
    top = ordered.latest_per_key(table(spark, d, "issuer_decisions").select("cse_filing_id", "id", "status"), ["cse_filing_id"], [F.desc("id")])
    return table(spark, d, "filings").select("delivery_no", "cse_filing_id").join(top, "cse_filing_id", "left").select("delivery_no", F.col("id").alias("decision_id"), "status")


@_query("""with s as (select date_trunc('day', first_seen_at at time zone 'UTC')::date as a, date_trunc('day', last_seen_at at time zone 'UTC')::date as b from filings),
days as (select unnest(range((select min(a) from s), (select max(b) from s) + interval 1 day, interval 1 day))::date as day)
select day, count(a) as n_listed from days left join s on a <= day and b >= day group by all""")
def j6_universe_per_day(spark, d):
    rows = table(spark, d, "filings").select(F.to_date("first_seen_at").alias("a"), F.to_date("last_seen_at").alias("b"))
    return ranges.active_per_day(rows, "a", "b", "day", "n_listed")


@_query("with " + _MEMBERS + """ select a.fact, count(*) as n_pairs, count(*) filter (where abs(a.v - b.v) <= a.h + b.h) as n_agreeing from (select *, row_number() over (partition by fact order by document, ord, part, v) as i from members) a
join (select *, row_number() over (partition by fact order by document, ord, part, v) as i from members) b on a.fact = b.fact and a.i < b.i group by all""")  # fmt: skip
def j9_pairwise_agreement(spark, d):
    """Values whose intervals touch agree; pairs that are apart are counted, none is formed."""
    m = members(spark, d)
    return ranges.touching_pairs(m, "fact", F.col("v") - F.col("h"), F.col("v") + F.col("h"))


@_query(r"""with c as (select distinct regexp_extract(path, '/(\d+)_', 1) as sec_id, source_symbol from filings where regexp_matches(path, '/(\d+)_'))
select sec_id, count(*) as n_claimants, (count(*) * (count(*) + 1) / 2)::bigint as n_pairs from c group by all having count(*) > 1""")
def j12_claimants(spark, d):
    c = table(spark, d, "filings").select(F.regexp_extract("path", r"/(\d+)_", 1).alias("sec_id"), "source_symbol").where(F.col("sec_id") != "").distinct()
    n = F.count(F.lit(1))
    return c.groupBy("sec_id").agg(n.alias("n_claimants"), F.call_function("div", n * (n + 1), F.lit(2).cast("long")).alias("n_pairs")).where(F.col("n_claimants") > 1)


@_query("""select s_suppkey, (select count(*) from customer c where abs(round(c_acctbal * 100)::bigint - round(s_acctbal * 100)::bigint) <= 500) as n_matches from supplier""")
def j13_tolerance_match(spark, d):
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    s = table(spark, d, "supplier").select("s_suppkey", cents("s_acctbal").alias("v"))
    c = table(spark, d, "customer").select(cents("c_acctbal").alias("w"))
    return ranges.count_within(s, "s_suppkey", "v", c, "w", 500, "n_matches")


@_query("""select 'filings_only' as side, count(*) as n from (select distinct source_symbol as s from filings) where s not in (select distinct split_part(query_symbol, '.', 1) from company_info_raw where query_symbol is not null)
union all select 'companies_only', count(*) from (select distinct split_part(query_symbol, '.', 1) as s from company_info_raw where query_symbol is not null) where s not in (select source_symbol from filings)""")  # fmt: skip
def j16_set_difference(spark, d):
    a = table(spark, d, "filings").select(F.col("source_symbol").alias("s")).distinct()
    b = table(spark, d, "company_info_raw").where(F.col("query_symbol").isNotNull()).select(F.split_part("query_symbol", F.lit("."), F.lit(1)).alias("s")).distinct()
    side = lambda x, y, n: x.join(y, "s", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("side"), "n")
    return side(a, b, "filings_only").unionByName(side(b, a, "companies_only"))


@_query("""with n as (select l_orderkey, count(*) as n from lineitem group by all), o as (select l_orderkey, unnest(range(n)) as i from n), h as (select distinct l_orderkey, l_linenumber - 1 as i from lineitem),
p as (select a.l_orderkey, a.i, b.i as j from o a join o b on a.l_orderkey = b.l_orderkey and a.i < b.i)
select l_orderkey, i::int as i, j::int as j from p where not exists (select 1 from h where h.l_orderkey = p.l_orderkey and h.i = p.i) or not exists (select 1 from h where h.l_orderkey = p.l_orderkey and h.i = p.j)""")  # fmt: skip
def j17_missing_pairs(spark, d):
    """Of every order, whatever its number of lines, the pairs that lack either ordinal."""
    got = ranges.missing_pairs(table(spark, d, "lineitem"), "l_orderkey", F.col("l_linenumber") - 1)
    return got.select("l_orderkey", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"))


@_query("select o_custkey, count(*) as n, count(*) filter (where o_orderstatus = 'F') as n_f, count(distinct o_orderpriority) as n_p, list_sort(list(distinct o_orderpriority)) as priorities from orders group by all having count(distinct o_orderpriority) > 2")
def a1_counts_and_sets(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_f"), F.count_distinct("o_orderpriority").alias("n_p"), F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    return o.where(F.col("n_p") > 2)


@_query("""with d as (select source_symbol, list_sort(list(date_diff('day', first_seen_at, last_seen_at))) as v from filings group by all)
select source_symbol, v[1] as least, v[len(v)] as most, list_aggregate(v, 'median') as median, v[round_even(0.9::decimal(2,1) * (len(v) - 1), 0)::int + 1] as p90 from d""")
def a10_order_statistics(spark, d):
    days = F.date_diff(F.to_date("last_seen_at"), F.to_date("first_seen_at"))
    rows = table(spark, d, "filings").select("source_symbol", days.cast("long").alias("v"))
    return ordered.order_statistics(rows, "source_symbol", "v")


@_query("""with f as (select distinct cse_filing_id from filings), s as (select f.cse_filing_id, exists(select 1 from classifications c where c.cse_filing_id = f.cse_filing_id) as a, exists(select 1 from issuer_decisions c where c.cse_filing_id = f.cse_filing_id) as b,
exists(select 1 from extraction_runs c where c.cse_filing_id = f.cse_filing_id) as c, exists(select 1 from reported_values c where c.cse_filing_id = f.cse_filing_id) as d from f),
r as (select 1 + case when a then 1 + case when b then 1 + case when c then 1 + case when d then 1 else 0 end else 0 end else 0 end else 0 end as reached from s)
select k::int as stage, count(*) filter (where reached >= k) as n_reached, count(*) filter (where reached = k) as n_stopped from r, range(1, 6) t(k) group by all""")  # fmt: skip
def a11_coverage_funnel(spark, d):
    f = table(spark, d, "filings").select("cse_filing_id").distinct()
    stages = ["classifications", "issuer_decisions", "extraction_runs", "reported_values"]
    for i, t in enumerate(stages):
        f = f.join(table(spark, d, t).select("cse_filing_id").distinct().withColumn(f"s{i}", F.lit(True)), "cse_filing_id", "left")
    reached = F.lit(0)
    for i in reversed(range(len(stages))):
        reached = F.when(F.col(f"s{i}"), 1 + reached).otherwise(0)
    per = f.groupBy((1 + reached).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    rows = per.select(F.explode(F.sequence(F.lit(1), F.lit(5))).alias("stage"), "r", "n")
    zero = F.lit(0).cast("long")
    return rows.groupBy("stage").agg(F.sum(F.when(F.col("r") >= F.col("stage"), F.col("n")).otherwise(zero)).alias("n_reached"), F.sum(F.when(F.col("r") == F.col("stage"), F.col("n")).otherwise(zero)).alias("n_stopped"))


@_query("""select dimension, value, count(*) as n from (select unnest(['type', 'status', 'version']) as dimension, unnest([document_type, document_type_status, classifier_version]) as value from (select distinct * from classifications)) group by all""")
def a12_dimension_counts(spark, d):
    dims = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(c).alias("value")) for n, c in (("type", "document_type"), ("status", "document_type_status"), ("version", "classifier_version"))])
    return table(spark, d, "classifications").distinct().select(F.inline(dims)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


@_query("""with y as (select distinct o_custkey, year(o_orderdate) as y from orders), b as (select o_custkey, min(y) as a, max(y) as z from y group by all)
select b.o_custkey, g.y::int as missing_year from b, range(1990, 2010) g(y) where g.y between a and z and not exists (select 1 from y where y.o_custkey = b.o_custkey and y.y = g.y)""")
def a14_missing_years(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.year("o_orderdate")).alias("ys"))
    return g.select("o_custkey", F.explode(F.array_except(F.sequence(F.array_min("ys"), F.array_max("ys")), "ys")).alias("missing_year"))


@_query("select (observed_at at time zone 'UTC' + interval 330 minute)::date as local_day, lower(trim(source_endpoint)) as endpoint, count(*) as n_requests, greatest(0, 400 - count(*)) as budget_left from filing_observations group by all")
def a22_requests_per_day(spark, d):
    rows = table(spark, d, "filing_observations").select(F.to_date(F.from_utc_timestamp("observed_at", "+05:30")).alias("local_day"), F.lower(F.trim("source_endpoint")).alias("endpoint"))
    n = F.count(F.lit(1))
    return rows.groupBy("local_day", "endpoint").agg(n.alias("n_requests"), F.greatest(F.lit(0).cast("long"), 400 - n).alias("budget_left"))


@_query("""select cse_filing_id, case when bool_or(ep like '%getfinancialannouncement') and bool_or(ep like '%financials') then 'both' when bool_or(ep like '%getfinancialannouncement') then 'feed' when bool_or(ep like '%financials') then 'listing' else 'none' end as sources
from (select cse_filing_id, lower(trim(source_endpoint)) as ep from filing_observations) group by all""")
def u3_source_label(spark, d):
    ep = listing.endpoint_name("source_endpoint")
    g = table(spark, d, "filing_observations").select("cse_filing_id", (ep == "getfinancialannouncement").alias("f"), (ep == "financials").alias("l")).groupBy("cse_filing_id").agg(F.bool_or("f").alias("f"), F.bool_or("l").alias("l"))
    return g.select("cse_filing_id", F.when(F.col("f") & F.col("l"), "both").when(F.col("f"), "feed").when(F.col("l"), "listing").otherwise("none").alias("sources"))


# The check's engine has no look-around: the characters before and after an amount stand in groups, and
# blanks are doubled while it runs, so that neighbouring amounts do not share theirs.
_W, _NUM = r"\p{L}\p{N}_", r"\p{Nd}"
_REDACTIONS = (
    rf"(^|[^{_W}.,/-])(\(?-?{_NUM}{{1,3}}(?:,{_NUM}{{3}})+(?:\.{_NUM}+)?\)?)($|[^{_W},/-])",
    rf"(^|[^{_W}.,/-])(\(?-?{_NUM}+\.{_NUM}+\)?%?)($|[^{_W}./-])",
    rf"(^|[^{_W}.,/-])(-?{_NUM}+(?:\.{_NUM}+)?(?:  )?%)()",
    rf"(^|[^{_W}.,/-])({_NUM}{{5,}})($|[^{_W}.,/-])",
    rf"(^| )([,.]{_NUM}[{_NUM},.]*)()",
)


def _redacted_sql(text: str) -> str:
    out = rf"replace(trim(regexp_replace(coalesce({text}, ''), '[\s\p{{Z}}]+', ' ', 'g')), ' ', '  ')"
    for pattern in _REDACTIONS:
        out = rf"regexp_replace({out}, '{pattern}', '\1#\3', 'g')"
    return f"replace({out}, '  ', ' ')"


@_query("select sha256(t) as redacted_sha256, left(t, 160) as snippet, count(*) as n from (select " + _redacted_sql("text") + " as t from documents) group by all")
def x17_redaction(spark, d):
    """Whole texts redacted, told apart by all of their result, of which the first 160 characters are shown."""
    t = table(spark, d, "documents").select(texts.redacted("text").alias("t"))
    rows = t.select(F.sha2("t", 256).alias("redacted_sha256"), F.substring("t", 1, 160).alias("snippet"))
    return rows.groupBy("redacted_sha256", "snippet").agg(F.count(F.lit(1)).alias("n"))


# A document path ends in <security id>_<epoch of 10 to 13 digits>.<extension>; 13 digits are milliseconds, fewer are seconds.
_PATH_END = r"(?:^|/)(\d+)_(\d{10,13})\.[A-Za-z0-9]+$"


@_query(rf"""select delivery_no, regexp_extract(path, '{_PATH_END}', 1) as sec_id, case when length(e) = 13 then e::bigint else e::bigint * 1000 end as epoch_ms from (select *, regexp_extract(path, '{_PATH_END}', 2) as e from filings where regexp_matches(path, '{_PATH_END}'))""")
def x18_path_epoch(spark, d):
    rows = table(spark, d, "filings").select("delivery_no", texts.path_security("path").alias("sec_id"), texts.path_epoch("path").alias("epoch_ms"))
    return rows.where(F.col("epoch_ms").isNotNull())


@_query("""select delivery_no, (uploaded_at at time zone 'UTC' + interval 330 minute)::date as colombo_date, strftime(uploaded_at at time zone 'UTC' + interval 330 minute, '%H:%M:%S') = '00:00:00' as at_midnight from filings""")
def x20_colombo_date(spark, d):
    local = F.from_utc_timestamp("uploaded_at", "+05:30")
    return table(spark, d, "filings").select("delivery_no", F.to_date(local).alias("colombo_date"), (F.date_format(local, "HH:mm:ss") == "00:00:00").alias("at_midnight"))


@_query("""select view_id, sha256('{"cse_filing_id":' || cse_filing_id || ',"f5_run_id":' || coalesce('"' || lower(trim(f5_run_id)) || '"', 'null') || ',"rule_version":"' || rule_version || '"}') as identity_key from knowledge_views""")
def x23_identity_hash(spark, d):
    j = F.concat(F.lit('{"cse_filing_id":'), F.col("cse_filing_id").cast("string"), F.lit(',"f5_run_id":'), F.coalesce(F.concat(F.lit('"'), F.lower(F.trim("f5_run_id")), F.lit('"')), F.lit("null")), F.lit(',"rule_version":"'), F.col("rule_version"), F.lit('"}'))
    return table(spark, d, "knowledge_views").select("view_id", F.sha2(j, 256).alias("identity_key"))


@_query("""select f5_run_id, case when document_retrieved_at is not null and path_epoch_at is not null then epoch_us(greatest(recorded_at, document_retrieved_at, path_epoch_at)) end as known_at_us from (select distinct * from extraction_runs)""")
def d22_knowledge_time(spark, d):
    r = table(spark, d, "extraction_runs").distinct()
    chain = ("recorded_at", "document_retrieved_at", "path_epoch_at")
    whole = F.forall(F.array(*[F.col(c).isNotNull() for c in chain]), lambda x: x)
    return r.select("f5_run_id", F.when(whole, F.unix_micros(F.greatest(*chain))).alias("known_at_us"))


@_query("""with v as (select cse_filing_id, document_sha256 as sha, min(document_retrieved_at) as got, count(*) filter (where document_retrieved_at is null) as lacks from (select distinct * from extraction_runs) group by all),
f as (select cse_filing_id, count(*) as n, sum(lacks) as lacks, min(got) as first, count(*) filter (where got = (select min(w.got) from v w where w.cse_filing_id = v.cse_filing_id)) as ties from v group by all)
select v.cse_filing_id, v.sha, case when f.n = 1 then 'base' when f.lacks > 0 or f.ties > 1 then 'unordered' when v.got = f.first then 'base' else 'later' end as role from v join f using (cse_filing_id)""")  # fmt: skip
def d21_version_roles(spark, d):
    v = table(spark, d, "extraction_runs").distinct().groupBy("cse_filing_id", F.col("document_sha256").alias("sha")).agg(F.min("document_retrieved_at").alias("got"), F.count_if(F.col("document_retrieved_at").isNull()).alias("lacks"))
    w = Window.partitionBy("cse_filing_id")
    first = F.min("got").over(w)
    v = v.withColumns({"_n": F.count(F.lit(1)).over(w), "_l": F.sum("lacks").over(w), "_f": first}).withColumn("_t", F.count_if(F.col("got") == F.col("_f")).over(w))
    return v.select("cse_filing_id", "sha", F.when(F.col("_n") == 1, "base").when((F.col("_l") > 0) | (F.col("_t") > 1), "unordered").when(F.col("got") == F.col("_f"), "base").otherwise("later").alias("role"))


@_query("""with m as (select distinct strftime(classified_at at time zone 'UTC', '%Y-%m') as month from classifications)
select strftime(g, '%Y-%m') as month, (m.month is not null) as closed from (select unnest(range((select min(classified_at at time zone 'UTC') from classifications), (select max(classified_at at time zone 'UTC') from classifications) + interval 1 month, interval 1 month)) as g) left join m on m.month = strftime(g, '%Y-%m')
where strftime(g, '%Y-%m') <= (select max(month) from m)""")  # fmt: skip
def d32_month_plan(spark, d):
    month = F.trunc(F.to_date("classified_at"), "month")
    done = table(spark, d, "classifications").select(month.alias("m")).where(F.col("m").isNotNull()).distinct()
    plan = done.agg(F.min("m").alias("a"), F.max("m").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("m"))
    return plan.join(done.withColumn("x", F.lit(True)), "m", "left").select(F.date_format("m", "yyyy-MM").alias("month"), F.coalesce("x", F.lit(False)).alias("closed"))


@_query(r"""select distinct 'extraction_runs' as table_name, f5_run_id as row_key from extraction_runs e where f5_run_id is not null and not exists (select 1 from reported_values v where nullif(lower(regexp_replace(v.f5_run_id, '^[\s{]+|[\s}]+$', '', 'g')), '') = lower(e.f5_run_id))""")
def d33_runs_without_values(spark, d):
    have = table(spark, d, "reported_values").select(keys.uuid_key("f5_run_id").alias("k")).distinct()
    runs = table(spark, d, "extraction_runs").select("f5_run_id").where(F.col("f5_run_id").isNotNull()).distinct()
    return runs.join(have, F.lower("f5_run_id") == F.col("k"), "left_anti").select(F.lit("extraction_runs").alias("table_name"), F.col("f5_run_id").alias("row_key"))
