"""Queries of operators not covered elsewhere: dictionaries, intervals, periods, cross-checks, status counts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.functions import listing
from tracewell.operators.ordered import with_previous
from tracewell.plans.reference import _SOURCES, QUERIES, SQL, _query
from tracewell.sources.tables import table

__all__ = ["QUERIES", "SQL"]


def _n():
    return F.count(F.lit(1))


@_query("""select o.delivery_no, f.first_delivery from filing_observations o left join (select cse_filing_id, min(delivery_no) as first_delivery, min(first_seen_at) as seen from filings group by all) f on f.cse_filing_id = o.cse_filing_id and o.observed_at >= f.seen""")
def j11_interval_join(spark, d):
    f = table(spark, d, "filings").groupBy("cse_filing_id").agg(F.min("delivery_no").alias("first_delivery"), F.min("first_seen_at").alias("seen"))
    o = table(spark, d, "filing_observations").select("delivery_no", "cse_filing_id", "observed_at")
    return o.join(f, (o["cse_filing_id"] == f["cse_filing_id"]) & (o["observed_at"] >= f["seen"]), "left").select("delivery_no", "first_delivery")


_KINDS = {"annual_report": "yearly", "interim_financial_statements": "part-year", "audited_financial_statements": "yearly"}


@_query("select coalesce(k.family, 'unmapped') as family, count(*) as n from (select distinct * from classifications) c left join (select unnest([" + ", ".join(f"'{k}'" for k in _KINDS) + "]) as t, unnest([" + ", ".join(f"'{v}'" for v in _KINDS.values()) + "]) as family) k on k.t = c.document_type group by all")
def j15_dictionary_lookup(spark, d):
    k = F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv])
    return table(spark, d, "classifications").distinct().groupBy(F.coalesce(F.try_element_at(k, F.col("document_type")), F.lit("unmapped")).alias("family")).agg(_n().alias("n"))


@_query("""select o_orderkey, (date_trunc('month', o_orderdate) + interval 1 month - interval 1 day)::date as period_end, (date_trunc('month', o_orderdate) - interval 2 month)::date as period_start,
'Q' || (((month(o_orderdate) + 12 - 4) % 12) // 3 + 1) as fiscal_quarter from orders""")  # fmt: skip
def x7_fiscal_labels(spark, d):
    """Quarters of a fiscal year that ends in March; three-month periods to the end of the month."""
    day = F.to_date("o_orderdate")
    quarter = F.floor(F.pmod(F.month(day) - 4, F.lit(12)) / 3).cast("int") + 1
    return table(spark, d, "orders").select("o_orderkey", F.last_day(day).alias("period_end"), F.add_months(F.trunc(day, "month"), -2).alias("period_start"), F.concat(F.lit("Q"), quarter.cast("string")).alias("fiscal_quarter"))


@_query("""select l_orderkey, l_linenumber, case when p is null then 'not_found' when v = p then 'matched' when v = -p then 'sign_differs' when abs(v - p) <= 1 then 'rounding_only' else 'differs' end as verdict, count(*) as n
from (select l_orderkey, l_linenumber, round(l_extendedprice)::bigint as v, round(p_retailprice * l_quantity)::bigint as p from lineitem left join part on p_partkey = l_partkey) group by all""")
def d34_companion_check(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"), "left")
    v, p = F.round("l_extendedprice").cast("long"), F.round(F.col("p_retailprice") * F.col("l_quantity")).cast("long")
    verdict = F.when(p.isNull(), "not_found").when(v == p, "matched").when(v == -p, "sign_differs").when(F.abs(v - p) <= 1, "rounding_only").otherwise("differs")
    return j.groupBy("l_orderkey", "l_linenumber", verdict.alias("verdict")).agg(_n().alias("n"))


@_query("""select status, basis, count(*) as n, count(distinct cse_filing_id) as n_filings from (select distinct * from issuer_decisions) group by all""")
def d37_status_counts(spark, d):
    return table(spark, d, "issuer_decisions").distinct().groupBy("status", "basis").agg(_n().alias("n"), F.count_distinct("cse_filing_id").alias("n_filings"))


@_query("""select currency, value_type, count(*) as n, count(distinct cse_filing_id) as n_filings, count(*) filter (where parsed_value is null) as n_unparsed from (select distinct * from reported_values) group by all""")
def a17_value_summary(spark, d):
    return table(spark, d, "reported_values").distinct().groupBy("currency", "value_type").agg(_n().alias("n"), F.count_distinct("cse_filing_id").alias("n_filings"), F.count_if(F.col("parsed_value").isNull()).alias("n_unparsed"))


@_query("""select bucket, count(*) as n, count(distinct cse_filing_id) as n_filings from (select cse_filing_id, unnest(source_buckets) as bucket from filings) group by all""")
def a15_array_elements(spark, d):
    return table(spark, d, "filings").select("cse_filing_id", F.explode("source_buckets").alias("bucket")).groupBy("bucket").agg(_n().alias("n"), F.count_distinct("cse_filing_id").alias("n_filings"))


@_query("""select symbol, min(place) as place from (select source_symbol as symbol, 0 as place from filings union all select split_part(query_symbol, '.', 1), 1 from company_info_raw where query_symbol is not null) group by all""")
def u2_ordered_union(spark, d):
    a = table(spark, d, "filings").select(F.col("source_symbol").alias("symbol"), F.lit(0).alias("place"))
    b = table(spark, d, "company_info_raw").where(F.col("query_symbol").isNotNull()).select(F.split_part("query_symbol", F.lit("."), F.lit(1)).alias("symbol"), F.lit(1).alias("place"))
    return a.unionByName(b).groupBy("symbol").agg(F.min("place").alias("place"))


@_query("""select event_id, rank from (select event_id, row_number() over (partition by user_id, ts::date order by case event_type when 'purchase' then 0 when 'click' then 1 else 2 end, ts desc, event_id) as rank from events) where rank <= 3""")
def t3_precedence_then_recency(spark, d):
    order = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy(order, F.desc("ts"), "event_id")
    return table(spark, d, "events").withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= 3).select("event_id", "rank")


@_query("""select event_id, json_extract_string(props, '$.k')::bigint as k, json_type(props::json, '$.k') is not null as has_k from events""")
def x32_json_inspection(spark, d):
    m = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", F.try_element_at(m, F.lit("k")).try_cast("long").alias("k"), F.map_contains_key(m, F.lit("k")).alias("has_k"))


@_query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day_text, day(o_orderdate) as dom, greatest(o_totalprice::decimal(18,2), 150000) as floored, length(trim(o_orderpriority)) as len, sha256(o_orderpriority) as h from orders""")
def x33_sql_scalars(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"), F.dayofmonth("o_orderdate").cast("long").alias("dom"), F.greatest(F.col("o_totalprice").cast("decimal(18,2)"), F.lit(150000).cast("decimal(18,2)")).alias("floored"), F.length(F.trim("o_orderpriority")).cast("long").alias("len"), F.sha2("o_orderpriority", 256).alias("h"))


@_query("with " + _SOURCES + """, r as (select *, row_number() over (partition by cse_filing_id order by observed_at, delivery_no) as na, row_number() over s as ns, lag(content) over s as pc from sources window s as (partition by cse_filing_id, ep, bk, qs order by observed_at, delivery_no))
select delivery_no, case when na = 1 then 'new_filing' when ns = 1 then 'new_source' when content is not distinct from pc then 'unchanged' else 'metadata_changed' end as outcome from r""")  # fmt: skip
def d5_observation_outcomes(spark, d):
    """Against the source's current version, by the content hash computed again: A, B, A is a change back."""
    o = table(spark, d, "filing_observations").select("delivery_no", "cse_filing_id", listing.endpoint_name("source_endpoint").alias("ep"), listing.bucket_name("source_bucket").alias("bk"), F.coalesce("query_symbol", F.lit("")).alias("qs"), F.sha2(listing.raw_content("raw_item"), 256).alias("h"), "observed_at")
    first = o.groupBy(F.col("cse_filing_id").alias("_id")).agg(F.min(F.struct("observed_at", "delivery_no")).alias("_first"))
    o = with_previous(o, ["cse_filing_id", "ep", "bk", "qs"], ["observed_at", "delivery_no"], ["h"]).join(first, F.col("cse_filing_id").eqNullSafe(F.col("_id")))
    new = F.col("_first.delivery_no") == F.col("delivery_no")
    outcome = F.when(new, "new_filing").when(F.col("_seq") == 1, "new_source").when(F.col("h").eqNullSafe(F.col("_prev.h")), "unchanged").otherwise("metadata_changed")
    return o.select("delivery_no", outcome.alias("outcome"))
