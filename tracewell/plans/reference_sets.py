"""Queries of the remaining data-processing operators: chains, populations, tallies, keys, runs and audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.functions import keys, listing, texts
from tracewell.operators import evidence, ordered
from tracewell.plans.reference import QUERIES, SQL, _MEMBERS, _query, members
from tracewell.sources.tables import table

__all__ = ["QUERIES", "SQL"]


def _n():
    return F.count(F.lit(1))


def _zero():
    return F.lit(0).cast("long")


@_query(r"""select v.concept_key, count(*) as n_values, count(c.id) as n_classified, count(f.cse_filing_id) as n_filed from (select distinct * from reported_values) v
join (select distinct f5_run_id, classification_id from extraction_runs) r on r.f5_run_id = nullif(lower(regexp_replace(v.f5_run_id, '^[\s{]+|[\s}]+$', '', 'g')), '')
left join (select distinct id, cse_filing_id from classifications) c on c.id = nullif(lower(regexp_replace(r.classification_id, '^[\s{]+|[\s}]+$', '', 'g')), '') left join (select distinct cse_filing_id from filings) f on f.cse_filing_id = c.cse_filing_id group by all""")
def j1_provenance_chain(spark, d):
    v = table(spark, d, "reported_values").distinct().select("concept_key", keys.uuid_key("f5_run_id").alias("run"))
    r = table(spark, d, "extraction_runs").select(F.col("f5_run_id").alias("run"), keys.uuid_key("classification_id").alias("cls")).distinct()
    c = table(spark, d, "classifications").select(F.col("id").alias("cls"), "cse_filing_id").distinct().withColumn("_c", F.lit(1))
    f = table(spark, d, "filings").select("cse_filing_id").distinct().withColumn("_f", F.lit(1))
    # Values are counted per (run, concept) before they meet the chain.
    n = v.groupBy("run", "concept_key").agg(_n().alias("n"))
    j = n.join(r, "run").join(c, "cls", "left").join(f, "cse_filing_id", "left")
    has = lambda x: F.sum(F.when(F.col(x).isNotNull(), F.col("n")).otherwise(_zero()))
    return j.groupBy("concept_key").agg(F.sum("n").alias("n_values"), has("_c").alias("n_classified"), has("_f").alias("n_filed"))


@_query("""select f.delivery_no, count(r.f5_run_id) as n_runs from filings f left join (select distinct f5_run_id, cse_filing_id from extraction_runs where builder_version = 'f5.4') r on r.cse_filing_id = f.cse_filing_id group by all""")
def j2_left_with_version(spark, d):
    r = table(spark, d, "extraction_runs").where(F.col("builder_version") == "f5.4").select("f5_run_id", "cse_filing_id").distinct().groupBy("cse_filing_id").agg(F.count("f5_run_id").alias("n"))
    return table(spark, d, "filings").select("delivery_no", "cse_filing_id").join(r, "cse_filing_id", "left").select("delivery_no", F.coalesce("n", _zero()).alias("n_runs"))


@_query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderpriority like '1%')")
def j3_semi_population(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where(F.col("o_orderpriority").startswith("1")), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@_query("select o_orderkey from orders o where not exists (select 1 from lineitem where l_orderkey = o.o_orderkey)")
def j4_without_children(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


_CUTS = ["2024-02-01", "2024-07-01", "2025-01-01", "2025-07-01"]


@_query("with g as (select unnest([" + ", ".join(f"timestamptz '{c} 00:00:00+00'" for c in _CUTS) + """]) as g),
r as (select g, status, row_number() over (partition by g, cse_filing_id order by id desc) as rn from g join (select distinct id, cse_filing_id, status, decided_at from issuer_decisions) on decided_at <= g)
select strftime(g at time zone 'UTC', '%Y-%m-%d') as cutoff, status, count(*) as n_filings from r where rn = 1 group by all""")  # fmt: skip
def j8_in_force_at_cutoffs(spark, d):
    cuts = F.array(*[F.struct(F.lit(c).alias("cutoff"), F.lit(f"{c} 00:00:00").cast("timestamp").alias("g")) for c in _CUTS])
    r = table(spark, d, "issuer_decisions").select("cse_filing_id", "id", "status", "decided_at", F.explode(cuts).alias("c")).where(F.col("decided_at") <= F.col("c.g"))
    top = r.groupBy("c.cutoff", "cse_filing_id").agg(F.max_by("status", "id").alias("status"))
    return top.groupBy("cutoff", "status").agg(_n().alias("n_filings"))


@_query("""with v as (select distinct cse_filing_id, document_sha256 as sha, min(recorded_at) over (partition by cse_filing_id, document_sha256) as at from extraction_runs)
select a.cse_filing_id, a.sha as later_sha, b.sha as earlier_sha from v a join v b on a.cse_filing_id = b.cse_filing_id and a.sha <> b.sha and a.at > b.at""")  # fmt: skip
def d23_supersession_edges(spark, d):
    """Every pair of a filing's versions that differ in time is in the result, so the join forms no other."""
    v = table(spark, d, "extraction_runs").groupBy("cse_filing_id", F.col("document_sha256").alias("sha")).agg(F.min("recorded_at").alias("at"))
    a, b = v.select("cse_filing_id", F.col("sha").alias("later_sha"), F.col("at").alias("_later")), v.select("cse_filing_id", F.col("sha").alias("earlier_sha"), F.col("at").alias("_earlier"))
    return a.join(b, "cse_filing_id").where(F.col("_later") > F.col("_earlier")).select("cse_filing_id", "later_sha", "earlier_sha")


@_query("select document_sha256, count(distinct cse_filing_id) as n_filings, list_sort(list(distinct cse_filing_id))[1:10] as examples from extraction_runs group by all having count(distinct cse_filing_id) > 1")
def a2_documents_filed_twice(spark, d):
    g = table(spark, d, "extraction_runs").select("document_sha256", "cse_filing_id").distinct().groupBy("document_sha256").agg(_n().alias("n_filings"), F.slice(F.array_sort(F.collect_list("cse_filing_id")), 1, 10).alias("examples"))
    return g.where(F.col("n_filings") > 1)


@_query("select source_symbol, string_agg(distinct document_type, ',' order by document_type) as kinds from (select f.source_symbol, c.document_type from (select distinct cse_filing_id, source_symbol from filings) f join classifications c on c.cse_filing_id = f.cse_filing_id) group by all")
def a3_distinct_list(spark, d):
    f = table(spark, d, "filings").select("cse_filing_id", "source_symbol").distinct()
    c = table(spark, d, "classifications").select("cse_filing_id", "document_type").distinct()
    return f.join(c, "cse_filing_id").groupBy("source_symbol").agg(F.array_join(F.array_sort(F.collect_set("document_type")), ",").alias("kinds"))


@_query("select l_orderkey, list(l_partkey order by l_linenumber, l_partkey, l_suppkey) as parts from lineitem group by all")
def a4_ordered_list(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x["l_partkey"]).alias("parts"))


@_query("select user_id, string_agg(event_type || '=' || n, ';' order by event_type) as counter from (select user_id, event_type, count(*) as n from events group by all) group by all")
def a5_counter(spark, d):
    n = table(spark, d, "events").groupBy("user_id", "event_type").agg(_n().alias("n"))
    text = F.transform(F.array_sort(F.collect_list(F.struct("event_type", "n"))), lambda x: F.concat_ws("=", x["event_type"], x["n"].cast("string")))
    return n.groupBy("user_id").agg(F.array_join(text, ";").alias("counter"))


@_query("""select count(distinct cse_filing_id) as n_ids, count(*) filter (where n_runs > 1) as n_in_several_runs, sum(n_rows - n_runs)::bigint as n_repeats from (select cse_filing_id, count(distinct discovery_run_id) as n_runs, count(*) as n_rows from filing_observations group by all)""")
def a18_discovery_totals(spark, d):
    per = table(spark, d, "filing_observations").groupBy("cse_filing_id").agg(F.count_distinct("discovery_run_id").alias("n_runs"), _n().alias("n_rows"))
    return per.agg(_n().alias("n_ids"), F.count_if(F.col("n_runs") > 1).alias("n_in_several_runs"), F.sum(F.col("n_rows") - F.col("n_runs")).alias("n_repeats"))


@_query("""select category, count(*) as n from (select case when path is null then 'no_path' when trim(path) = '' then 'blank_path' when manual_date_raw is null then 'no_manual_date' when authorized_at is null then 'not_authorized' else 'whole' end as category from filings) group by all""")
def a19_one_category_each(spark, d):
    kind = F.when(F.col("path").isNull(), "no_path").when(F.trim("path") == "", "blank_path").when(F.col("manual_date_raw").isNull(), "no_manual_date").when(F.col("authorized_at").isNull(), "not_authorized").otherwise("whole")
    return table(spark, d, "filings").groupBy(kind.alias("category")).agg(_n().alias("n"))


@_query("""select k as field, count(*) filter (where not list_contains(json_keys(raw_item::json), k)) as n_absent, count(*) filter (where list_contains(json_keys(raw_item::json), k) and json_extract_string(raw_item::json, '$.' || k) is null) as n_null,
count(*) filter (where json_extract_string(raw_item::json, '$.' || k) is not null) as n_other from filing_observations, (select unnest(['path', 'path2', 'manualDate', 'name']) as k) group by all""")  # fmt: skip
def a20_presence_tally(spark, d):
    rows = table(spark, d, "filing_observations").select(F.from_json("raw_item", "map<string,string>").alias("m"))
    f = rows.select("m", F.explode(F.array(*[F.lit(k) for k in ("path", "path2", "manualDate", "name")])).alias("field"))
    has, value = F.map_contains_key("m", F.col("field")), F.element_at("m", F.col("field"))
    return f.groupBy("field").agg(F.count_if(~has).alias("n_absent"), F.count_if(has & value.isNull()).alias("n_null"), F.count_if(value.isNotNull()).alias("n_other"))


@_query("""select count(*) as n, count(*) filter (where a = b) as n_exact, max(abs(a - b)) as largest, round(avg(abs(a - b))::double, 2) as mean_abs from (select uploaded_at_us // 1000000 as a, authorized_us // 1000000 as b from (select epoch_us(uploaded_at) as uploaded_at_us, epoch_us(authorized_at) as authorized_us from filings) where authorized_us is not null)""")
def a21_difference_stats(spark, d):
    sec = lambda c: F.floor(F.unix_micros(c) / 1_000_000).cast("long")
    r = table(spark, d, "filings").where(F.col("authorized_at").isNotNull()).select(sec("uploaded_at").alias("a"), sec("authorized_at").alias("b"))
    diff = F.abs(F.col("a") - F.col("b"))
    return r.agg(_n().alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_exact"), F.max(diff).alias("largest"), F.round(F.avg(diff), 2).alias("mean_abs"))


@_query("select source_symbol, count(*) as n, count(*) filter (where path is null) as n_bad from filings group by all having count(*) filter (where path is null) * 10 >= count(*) and count(*) filter (where path is null) >= 3")
def a25_share_thresholds(spark, d):
    g = table(spark, d, "filings").groupBy("source_symbol").agg(_n().alias("n"), F.count_if(F.col("path").isNull()).alias("n_bad"))
    return g.where((F.col("n_bad") * 10 >= F.col("n")) & (F.col("n_bad") >= 3))


@_query("select cse_filing_id, id, classifier_version from (select *, row_number() over (partition by cse_filing_id order by classified_at desc, id desc) as rn from (select distinct * from classifications) where document_type_status = 'confirmed') where rn = 1")
def w2_latest_successful(spark, d):
    rows = table(spark, d, "classifications").where(F.col("document_type_status") == "confirmed").select("cse_filing_id", "id", "classifier_version", "classified_at")
    return ordered.latest_per_key(rows, ["cse_filing_id"], [F.desc("classified_at"), F.desc("id")]).drop("classified_at")


@_query("""select user_id, arg_min(value, (ts, event_id)) as first_value, arg_max(value, (ts, event_id)) as last_value, count(distinct value) as n_values, count(distinct value) = 1 as constant from events where event_type = 'purchase' group by all""")
def w4_constancy(spark, d):
    e = table(spark, d, "events").where(F.col("event_type") == "purchase")
    at = F.struct("ts", "event_id")
    return e.groupBy("user_id").agg(F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"), F.count_distinct("value").alias("n_values"), (F.count_distinct("value") == 1).alias("constant"))


@_query("select distinct value_id, ord from (select value_id, row_number() over (partition by f5_run_id, statement_index, row_index order by column_index, value_id) - 1 as ord from (select distinct * from reported_values))")
def w6_ordinal_in_row(spark, d):
    w = Window.partitionBy("f5_run_id", "statement_index", "row_index").orderBy("column_index", "value_id")
    return table(spark, d, "reported_values").distinct().select("value_id", (F.row_number().over(w) - 1).cast("long").alias("ord")).distinct()


@_query("select user_id, count(*) as n_errors, least(30 * pow(2, count(*) - 1), 3600)::bigint as delay_s from events where event_type = 'error' group by all")
def w8_retry_delay(spark, d):
    g = table(spark, d, "events").where(F.col("event_type") == "error").groupBy("user_id").agg(_n().alias("n_errors"))
    return g.select("user_id", "n_errors", F.least(30 * F.pow(F.lit(2.0), F.col("n_errors") - 1), F.lit(3600.0)).cast("long").alias("delay_s"))


@_query("select user_id, count(*) as n_since from (select *, max(case when event_type = 'signup' then ts end) over (partition by user_id) as reset from events) where event_type = 'click' and (reset is null or ts > reset) group by all")
def w9_since_reset(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts")
    reset = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.max("ts").alias("reset"))
    return e.where(F.col("event_type") == "click").join(reset, "user_id", "left").where(F.col("reset").isNull() | (F.col("ts") > F.col("reset"))).groupBy("user_id").agg(_n().alias("n_since"))


@_query("select event_id from (select event_id, value::decimal(18,2) as v, lag(value::decimal(18,2)) over (partition by user_id order by ts, event_id) as p from events) where p <> 0 and abs(v - p) * 100 > 30 * abs(p)")
def w10_large_moves(spark, d):
    v = F.col("value").cast("decimal(18,2)")
    e = ordered.with_previous(table(spark, d, "events").select("user_id", "ts", "event_id", v.alias("v")), ["user_id"], ["ts", "event_id"], ["v"]).withColumn("p", F.col("_prev.v"))
    return e.where((F.col("p") != 0) & (F.abs(F.col("v") - F.col("p")) * 100 > 30 * F.abs(F.col("p")))).select("event_id")


@_query("select cse_filing_id, arg_min(document_sha256, (-reached, document_sha256)) as furthest from (select r.cse_filing_id, r.document_sha256, max(case when v.f5_run_id is null then 1 else 2 end) as reached from extraction_runs r left join (select distinct f5_run_id from reported_values) v on v.f5_run_id = r.f5_run_id group by all) group by all")
def t5_furthest_document(spark, d):
    v = table(spark, d, "reported_values").select("f5_run_id").distinct().withColumn("v", F.lit(1))
    r = table(spark, d, "extraction_runs").select("cse_filing_id", "document_sha256", "f5_run_id").join(v, "f5_run_id", "left")
    per = r.groupBy("cse_filing_id", "document_sha256").agg(F.max(F.when(F.col("v").isNull(), 1).otherwise(2)).alias("reached"))
    return per.groupBy("cse_filing_id").agg(F.min_by("document_sha256", F.struct(-F.col("reached"), "document_sha256")).alias("furthest"))


@_query("select * from (select 'filing' as kind, cse_filing_id::varchar as item, source_symbol as part from filings union all select 'decision', id::varchar, status from issuer_decisions union all select 'view', view_id::varchar, rule_version from knowledge_views)")
def u1_union_of_kinds(spark, d):
    a = table(spark, d, "filings").select(F.lit("filing").alias("kind"), F.col("cse_filing_id").cast("string").alias("item"), F.col("source_symbol").alias("part"))
    b = table(spark, d, "issuer_decisions").select(F.lit("decision").alias("kind"), F.col("id").cast("string").alias("item"), F.col("status").alias("part"))
    return a.unionByName(b).unionByName(table(spark, d, "knowledge_views").select(F.lit("view").alias("kind"), F.col("view_id").cast("string").alias("item"), F.col("rule_version").alias("part")))


@_query("select delivery_no, list_sort(list_filter(['annual', 'quarterly', 'other', 'web_link'], lambda x: not list_contains(source_buckets, x))) as missing from filings")
def u4_array_subtraction(spark, d):
    every = F.array(*[F.lit(x) for x in ("annual", "quarterly", "other", "web_link")])
    return table(spark, d, "filings").select("delivery_no", F.array_sort(F.array_except(every, "source_buckets")).alias("missing"))


@_query("select distinct cse_filing_id from listing_snapshots where snapshot_no = (select min(snapshot_no) from listing_snapshots) and cse_filing_id not in (select cse_filing_id from listing_snapshots where snapshot_no = (select max(snapshot_no) from listing_snapshots))")
def u5_disappeared(spark, d):
    s = table(spark, d, "listing_snapshots").select("snapshot_no", "cse_filing_id")
    end = lambda f: s.join(s.agg(f("snapshot_no").alias("snapshot_no")), "snapshot_no", "left_semi").select("cse_filing_id").distinct()
    return end(F.min).join(end(F.max), "cse_filing_id", "left_anti")


@_query(r"""select regexp_replace(regexp_replace(lower(label_raw), '\s*([/()-])\s*', '\1', 'g'), '^[ :.-]+|[ :.-]+$', '', 'g') as label, count(*) as n from (select distinct * from reported_values) group by all""")
def x2_label_normalisation(spark, d):
    label = F.regexp_replace(F.regexp_replace(F.lower("label_raw"), r"\s*([/()-])\s*", "$1"), r"^[ :.-]+|[ :.-]+$", "")
    return table(spark, d, "reported_values").distinct().groupBy(label.alias("label")).agg(_n().alias("n"))


@_query("""select value_id, case when raw_value like '(%' then 'parentheses' when raw_value like '-%' or raw_value like chr(8722) || '%' or raw_value like '%-' then 'minus' else 'positive' end as sign from (select distinct * from reported_values) where representation_class = 'number'""")
def x9_sign_as_printed(spark, d):
    r = F.col("raw_value")
    sign = F.when(r.startswith("("), "parentheses").when(r.startswith("-") | r.startswith("−") | r.endswith("-"), "minus").otherwise("positive")
    return table(spark, d, "reported_values").where(F.col("representation_class") == "number").distinct().select("value_id", sign.alias("sign"))


@_query(None)
def x15_date_tokens(spark, d):
    """Every date token of the filings' titles; the tokens of equal titles are found once."""
    titles = table(spark, d, "filings").groupBy("file_text").agg(_n().alias("n_filings"))
    return titles.select("file_text", "n_filings", F.explode(texts.date_tokens("file_text")).alias("t")).select("file_text", "n_filings", "t.*")


@_query("""select delivery_no, 'filing:' || cse_filing_id || ':' || strftime(uploaded_at at time zone 'UTC' + interval 330 minute, '%Y-%m') as item_key, coalesce(sha256(path), 'none') as path_version from filings""")
def x30_natural_keys(spark, d):
    k = F.concat_ws(":", F.lit("filing"), F.col("cse_filing_id").cast("string"), F.date_format(F.from_utc_timestamp("uploaded_at", "+05:30"), "yyyy-MM"))
    return table(spark, d, "filings").select("delivery_no", k.alias("item_key"), F.coalesce(F.sha2("path", 256), F.lit("none")).alias("path_version"))


@_query("""select delivery_no, lower(trim(metadata_hash)) as metadata_hash from filing_observations where metadata_hash is not null""")
def x24_content_hash(spark, d):
    rows = table(spark, d, "filing_observations").where(F.col("metadata_hash").isNotNull())
    return rows.select("delivery_no", F.sha2(listing.raw_content("raw_item"), 256).alias("metadata_hash"))


@_query("""with c as (select ts::date as day, user_id, bool_or(hour(ts) >= 12) as eod from events group by all), e as (select count(distinct user_id) as n from events)
select day, count(*) filter (where eod) as n_eod, (select n from e) as n_expected, case when count(*) filter (where eod) = 0 then 'missing' when count(*) filter (where eod) = (select n from e) then 'complete' else 'partial' end as state from c group by all""")  # fmt: skip
def d3_daily_completeness(spark, d):
    e = table(spark, d, "events")
    per = e.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.bool_or(F.hour("ts") >= 12).alias("eod")).groupBy("day").agg(F.count_if("eod").alias("n_eod"))
    out = keys.with_one_row(per, e.agg(F.count_distinct("user_id").alias("n_expected")))
    return out.select("day", "n_eod", "n_expected", F.when(F.col("n_eod") == 0, "missing").when(F.col("n_eod") == F.col("n_expected"), "complete").otherwise("partial").alias("state"))


@_query("with " + _MEMBERS + " select fact, document, count(*) as n_members, case when max(v - h) > min(v + h) then 'internally_conflicting' else 'consistent' end as state from members group by all")
def d16_source_observations(spark, d):
    m = members(spark, d)
    return m.groupBy("fact", "document").agg(_n().alias("n_members"), F.when(F.max(F.col("v") - F.col("h")) > F.min(F.col("v") + F.col("h")), "internally_conflicting").otherwise("consistent").alias("state"))


@_query("select document_sha256, arg_max(f5_run_id, (recorded_at, f5_run_id)) as run, count(*) as n_accepted from (select distinct * from extraction_runs) where builder_version in ('f5.3', 'f5.4') group by all")
def d17_run_selection(spark, d):
    r = table(spark, d, "extraction_runs").where(F.col("builder_version").isin("f5.3", "f5.4")).select("document_sha256", "f5_run_id", "recorded_at", "cse_filing_id").distinct()
    return r.groupBy("document_sha256").agg(F.max_by("f5_run_id", F.struct("recorded_at", "f5_run_id")).alias("run"), _n().alias("n_accepted"))


def _fingerprint_sql(where: str) -> str:
    limbs = " || '.' || ".join(f"coalesce(sum(('0x' || substr(h, {1 + 8 * i}, 8))::bigint) {where}, 0)::varchar" for i in range(8))
    return f"sha256(count(*) {where} || '.' || {limbs})"


@_query("with h as (select l_orderkey, l_shipdate, sha256(l_linenumber || ':' || l_partkey || ':' || l_suppkey) as h from lineitem), f as (select l_orderkey, " + _fingerprint_sql("") + " as fingerprint, " + _fingerprint_sql("filter (where l_shipdate <= timestamp '1999-01-01')") + " as before from h group by all) select l_orderkey, fingerprint from f where fingerprint <> before")
def d19_changed_partitions(spark, d):
    """A partition's fingerprint is its row count and the sums of its rows' hashes, so no partition is gathered."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")])
    rows = table(spark, d, "lineitem").select("l_orderkey", F.sha2(text, 256).alias("h"), (F.col("l_shipdate") <= F.lit("1999-01-01").cast("timestamp")).alias("old"))
    rows = rows.withColumn("h_old", F.when(F.col("old"), F.col("h")))
    sums = [c.alias(f"{name}_{i}") for name, h in (("now", "h"), ("was", "h_old")) for i, c in enumerate(ordered.limb_sums(h))]
    g = rows.groupBy("l_orderkey").agg(_n().alias("n"), F.count_if("old").alias("n_old"), *sums)
    print_of = lambda n, name: F.sha2(F.concat_ws(".", F.col(n).cast("string"), *[F.col(f"{name}_{i}").cast("string") for i in range(8)]), 256)
    return g.select("l_orderkey", print_of("n", "now").alias("fingerprint"), print_of("n_old", "was").alias("before")).where(F.col("fingerprint") != F.col("before")).select("l_orderkey", "fingerprint")


@_query("""select kind, count(*) as n from (select unnest([case when authorized_at < uploaded_at then 'authorized_before_upload' end, case when path is null then 'path_missing' end, case when uploaded_at > last_seen_at then 'uploaded_after_last_seen' end, case when len(listing_symbols) = 0 then 'feed_only' end]) as kind from filings) where kind is not null group by all""")
def d28_anomaly_counts(spark, d):
    checks = {"authorized_before_upload": ~(F.col("authorized_at") < F.col("uploaded_at")), "path_missing": F.col("path").isNotNull(), "uploaded_after_last_seen": ~(F.col("uploaded_at") > F.col("last_seen_at")), "feed_only": F.size("listing_symbols") > 0}
    return ordered.constraint_violations(table(spark, d, "filings"), "delivery_no", checks).groupBy(F.col("check_name").alias("kind")).agg(_n().alias("n"))


@_query("""select 'listing_only' as side, count(*) as n from (select cse_filing_id from listing_snapshots except select cse_filing_id from filing_observations) union all select 'observed_only', count(*) from (select cse_filing_id from filing_observations except select cse_filing_id from listing_snapshots)""")
def d38_both_directions(spark, d):
    a, b = (table(spark, d, t).select("cse_filing_id").distinct() for t in ("listing_snapshots", "filing_observations"))
    side = lambda x, y, n: x.join(y, "cse_filing_id", "left_anti").agg(_n().alias("n")).select(F.lit(n).alias("side"), "n")
    return side(a, b, "listing_only").unionByName(side(b, a, "observed_only"))


@_query("with " + _MEMBERS + """, lo as (select fact, document, max(v - h) as lo, min(v + h) as hi from members where known_at <= timestamp '1999-01-01' group by all)
select fact, count(*) as n_documents, max(lo) > min(hi) as conflicting from lo group by all""")  # fmt: skip
def d20_state_as_known(spark, d):
    m = evidence.visible_evidence(members(spark, d), "current", "known_at", "known_at", None, F.lit("1999-01-01").cast("timestamp"))
    per = m.groupBy("fact", "document").agg(F.max(F.col("v") - F.col("h")).alias("lo"), F.min(F.col("v") + F.col("h")).alias("hi"))
    return per.groupBy("fact").agg(_n().alias("n_documents"), (F.max("lo") > F.min("hi")).alias("conflicting"))
