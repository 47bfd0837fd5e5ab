"""Queries of the text, payload, identity and audit operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.functions import instants, keys, money, texts
from tracewell.operators import ordered
from tracewell.plans.problems_sql import _HEADINGS, _INSTANTS
from tracewell.plans.reference import QUERIES, SQL, _query
from tracewell.sources import listings
from tracewell.sources.tables import table

__all__ = ["QUERIES", "SQL"]


def _n():
    return F.count(F.lit(1))


@_query("""with b as (select raw_id, try_cast(any_value(body) as json) as j from company_info_raw group by raw_id),
l as (select raw_id, case json_type(j) when 'ARRAY' then j when 'OBJECT' then list_filter(list_transform(json_keys(j), lambda k: json_extract(j, '$."' || k || '"')), lambda v: json_type(v) = 'ARRAY')[1] end as rows from b)
select raw_id, json_array_length(rows)::bigint as n_rows from l where json_array_length(rows) > 0""")  # fmt: skip
def s4_row_list(spark, d):
    rows = table(spark, d, "company_info_raw").select("raw_id", "body").distinct()
    return listings.row_list(rows, "body").groupBy("raw_id").agg(_n().alias("n_rows"))


_BLOCK_NAMES = ["symbol", "name", "closingPrice", "marketCap", "isin", "securityId", "secId"]


@_query("""with b as (select raw_id, try_cast(any_value(body) as json) as j from company_info_raw group by raw_id), o as (select raw_id, case when json_type(j) = 'OBJECT' then j end as j from b),
k as (select raw_id, i, json_keys(j)[i] as block, json_extract(j, '$."' || json_keys(j)[i] || '"') as v from (select raw_id, j, unnest(range(1, len(json_keys(j)) + 1)) as i from o where j is not null)),
s as (select raw_id, block, i, len(list_intersect(json_keys(v), """ + str(_BLOCK_NAMES) + """)) as score from k where json_type(v) = 'OBJECT'),
r as (select *, row_number() over (partition by raw_id order by score desc, i) as rn, count(*) over (partition by raw_id, score) as n from s where score > 0)
select o.raw_id, block, coalesce(score, 0)::int as score, coalesce(n > 1, false) as ambiguous from o left join (select * from r where rn = 1) t on t.raw_id = o.raw_id""")  # fmt: skip
def f2_best_nested_block(spark, d):
    rows = table(spark, d, "company_info_raw").select("raw_id", "body").distinct()
    return listings.best_block(rows, "body", _BLOCK_NAMES).select("raw_id", "block", "score", "ambiguous")


@_query(r"""select delivery_no, verdict, case when verdict <> 'ok' then 0 when starts_with(path, 'upload_report_file/') then 2 else 1 end as n_candidates from (select delivery_no, path,
case when path is null then 'null' when regexp_matches(path, '^\s*$') then 'blank' when path <> trim(path, e' \t\r\n') then 'outer_white_space' when starts_with(path, '/') or contains(path, '://') or contains(path, '\') then 'not_relative' when regexp_matches(path, '[\x00-\x1f\x7f]') then 'control_character'
when len(list_filter(string_split(path, '/'), lambda x: x in ('', '.', '..'))) > 0 then 'empty_or_relative_segment' when ends_with(path, '.') then 'trailing_dot' else 'ok' end as verdict from filings)""")  # fmt: skip
def f6_path_acceptance(spark, d):
    return table(spark, d, "filings").select("delivery_no", texts.accepted_path("path").alias("verdict"), F.size(texts.path_candidates("path")).alias("n_candidates"))


@_query("""select raw_value, case when trim(raw_value) = '' then 'blank' when trim(raw_value) in ('-', '--', '- -', chr(8211), chr(8212)) then 'reported_nil' when lower(trim(raw_value)) in ('nil', 'nill', 'zero') then 'nil_word' when lower(trim(raw_value)) in ('n/a', 'na', 'n.a.', 'n.m.', 'not applicable') then 'not_applicable'
when contains(raw_value, '%') or contains(lower(raw_value), 'per cent') then 'percentage' when regexp_matches(raw_value, '\\d') and not starts_with(lower(trim(raw_value)), 'note') then 'numeric' else 'not_a_number' end as state, count(*) as n from reported_values group by all""")  # fmt: skip
def x10_value_state(spark, d):
    # Each distinct text is read once.
    n = table(spark, d, "reported_values").groupBy("raw_value").agg(_n().alias("n"))
    return n.select("raw_value", texts.value_state("raw_value").alias("state"), "n")


def _phrase_sql() -> str:
    """Places of the phrases of a duration: the length of what comes before."""
    before = lambda p: f"case when regexp_matches(t, '{p}') then length(regexp_extract(t, '(?s)^(.*?)(?:{p})', 1)) end"
    word = f"lower(regexp_extract(t, '{texts.MONTHS_PHRASE}', 1))"
    months = "case " + word + " " + " ".join(f"when '{w}' then {n}" for w, n in texts.NUMBERS.items()) + " end"
    found = [f"{{'at': {before(texts.MONTHS_PHRASE)}, 'months': {months}, 'label': {months} || 'M'}}"]
    found += [f"{{'at': {before(p)}, 'months': {n}, 'label': '{label}'}}" for p, n, label in texts.OTHER_PHRASES]
    return "list_sort(list_filter([" + ", ".join(found) + "], lambda x: x['at'] is not null))[1]"


@_query("select delivery_no, f['months']::int as months, case when f is not null then f['label'] when regexp_matches(t, '" + texts.ANY_PERIOD + "') then 'unspecified' end as label from (select delivery_no, t, " + _phrase_sql() + " as f from (select delivery_no, coalesce(file_text, '') as t from filings))")
def x16_duration_phrases(spark, d):
    p = texts.duration_phrase("file_text")
    return table(spark, d, "filings").select("delivery_no", p.getField("months").alias("months"), p.getField("label").alias("label"))


@_query("with found as (with " + _INSTANTS + ") select row_no as feed_row_no, utc_us from found where field_name = 'uploaded_date'")
def x19_feed_dates(spark, d):
    """Every upload date of the feed that means an instant, whatever its form."""
    rows = table(spark, d, "feed_items").select("feed_row_no", "uploaded_date")
    return instants.with_utc_micros(rows, "uploaded_date", None, "utc_us").where(F.col("utc_us").isNotNull()).select("feed_row_no", "utc_us")


@_query("with v as (select distinct scale_evidence, null::varchar as label_raw, null::varchar as currency from reported_values), " + _HEADINGS + " select v.scale_evidence, h.unit::bigint as unit_e4, h.code as currency_code from v left join heads h on h.scale_evidence = v.scale_evidence")
def x26_scale_evidence(spark, d):
    """What each heading text says of scale and currency; headings that differ say nothing."""
    @F.pandas_udf("unit_e4 long, currency_code string")
    def said(texts_: pd.Series) -> pd.DataFrame:
        found = [money.stated_by_headings(t) for t in texts_]
        return pd.DataFrame({"unit_e4": pd.array([u for u, _ in found], dtype="Int64"), "currency_code": [c for _, c in found]})

    rows = table(spark, d, "reported_values").select("scale_evidence").distinct()
    return rows.select("scale_evidence", said("scale_evidence").alias("x")).select("scale_evidence", "x.*")


@_query(r"""select regexp_extract(isin, '^ZZ(\d{4})', 1) as issuer_code, count(distinct raw_id) as n_bodies, count(distinct isin) as n_isins
from (select raw_id, unnest(regexp_extract_all(body, '"isin\\*"(?:\s|\\+[nrt])*:(?:\s|\\+[nrt])*\\*"(ZZ\d{4}[A-Z]\d)', 1)) as isin from company_info_raw) group by all""")
def x22_issuer_codes(spark, d):
    """Of every ISIN of a body, in JSON texts inside JSON texts as well."""
    every = F.regexp_extract_all("body", F.lit(r'"isin\\*"(?:\s|\\+[nrt])*:(?:\s|\\+[nrt])*\\*"(ZZ[0-9]{4}[A-Z][0-9])'), F.lit(1))
    r = table(spark, d, "company_info_raw").select("raw_id", F.explode(every).alias("isin")).distinct()
    return r.groupBy(F.regexp_extract("isin", r"^ZZ([0-9]{4})", 1).alias("issuer_code")).agg(F.count_distinct("raw_id").alias("n_bodies"), F.count_distinct("isin").alias("n_isins"))


@_query("""select delivery_no, replace(replace(url_encode(path), '%2F', '/'), '+', '%20') as url_path from filings""")
def x25_url_path(spark, d):
    return table(spark, d, "filings").select("delivery_no", texts.url_path("path").alias("url_path"))


@_query(r"""with b as (select raw_id, any_value(body) as body from company_info_raw group by raw_id)
select ltrim(regexp_replace(regexp_replace(t.fullkey, '^\$', ''), '\[([0-9]+)\]', '.\1', 'g'), '.') as path, count(*) as n from (select * from b where json_valid(body)) v, json_tree(v.body) t where t.key is not null and regexp_matches(t.key, '(?i)status|quarter|period') and not regexp_full_match(t.key, '[0-9]+') group by all""")
def x29_field_paths(spark, d):
    rows = table(spark, d, "company_info_raw").select("raw_id", "body").distinct()
    return rows.select("raw_id", F.explode(texts.field_paths("body", "status|quarter|period")).alias("path")).groupBy("path").agg(_n().alias("n"))


@_query(r"""with claims as (select distinct regexp_extract(path, '/(\d+)_', 1) as sec_id, source_symbol as symbol, upper(trim(source_name)) as name from filings where regexp_matches(path, '/(\d+)_')),
per as (select sec_id, count(distinct symbol) as n_symbols, count(distinct name) as n_names from claims group by all)
select sec_id, n_symbols, n_names, case when n_symbols = 1 then 'evidenced' when n_names = 1 then 'evidenced' when n_names > 1 then 'conflict:name_differs' else 'conflict:identity_evidence_insufficient' end as state from per""")  # fmt: skip
def d6_security_claims(spark, d):
    c = table(spark, d, "filings").select(F.regexp_extract("path", r"/(\d+)_", 1).alias("sec_id"), F.col("source_symbol").alias("symbol"), F.upper(F.trim("source_name")).alias("name")).where(F.col("sec_id") != "").distinct()
    g = c.groupBy("sec_id").agg(F.count_distinct("symbol").alias("n_symbols"), F.count_distinct("name").alias("n_names"))
    return g.withColumn("state", F.when((F.col("n_symbols") == 1) | (F.col("n_names") == 1), "evidenced").when(F.col("n_names") > 1, "conflict:name_differs").otherwise("conflict:identity_evidence_insufficient"))


@_query("""select f5_run_id, reason from (select f5_run_id, unnest([case when recorded_at > timestamptz '2025-01-01 00:00:00+00' then 'recorded_after_horizon' end, case when document_retrieved_at is null or path_epoch_at is null then 'knowledge_chain_incomplete' end,
case when cdn_last_modified is null then 'availability_unknown' when cdn_last_modified > timestamptz '2024-07-01 00:00:00+00' then 'not_available_by_cutoff' end]) as reason from (select distinct * from extraction_runs)) where reason is not null""")  # fmt: skip
def d26_explain_exclusions(spark, d):
    h, t = F.lit("2025-01-01 00:00:00").cast("timestamp"), F.lit("2024-07-01 00:00:00").cast("timestamp")
    m = F.col("cdn_last_modified")
    reasons = F.array_compact(F.array(
        F.when(F.col("recorded_at") > h, "recorded_after_horizon"),
        F.when(F.col("document_retrieved_at").isNull() | F.col("path_epoch_at").isNull(), "knowledge_chain_incomplete"),
        F.when(m.isNull(), "availability_unknown").when(m > t, "not_available_by_cutoff"),
    ))
    return table(spark, d, "extraction_runs").distinct().select("f5_run_id", F.explode(reasons).alias("reason"))


@_query("""select f5_run_id, count(*) as n_values, bool_or(raw_value like '(%') as any_negative, array_to_string(list_sort(list(distinct representation_class)), ',') as profile from (select distinct * from reported_values) group by all""")
def a16_run_profiles(spark, d):
    v = table(spark, d, "reported_values").distinct()
    return v.groupBy("f5_run_id").agg(_n().alias("n_values"), F.bool_or(F.col("raw_value").startswith("(")).alias("any_negative"), F.array_join(F.array_sort(F.collect_set("representation_class")), ",").alias("profile"))


@_query("""select document_sha256, mapper_version, count(distinct classification_id) as n_outputs from extraction_runs group by all having count(distinct classification_id) > 1""")
def k7_nondeterminism(spark, d):
    """Same input and version, different output."""
    g = table(spark, d, "extraction_runs").groupBy("document_sha256", "mapper_version").agg(F.count_distinct("classification_id").alias("n_outputs"))
    return g.where(F.col("n_outputs") > 1)


@_query("""select o_orderkey, (select count(*) from lineitem where l_orderkey = o_orderkey) as n_lines, (select count(distinct l_linenumber) from lineitem where l_orderkey = o_orderkey) as n_numbers from orders where (select count(*) from lineitem where l_orderkey = o_orderkey) <> (select count(distinct l_linenumber) from lineitem where l_orderkey = o_orderkey)""")
def d33b_recounts(spark, d):
    zero = F.lit(0).cast("long")
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(_n().alias("n_lines"), F.count_distinct("l_linenumber").alias("n_numbers"))
    j = table(spark, d, "orders").select("o_orderkey").join(g, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_numbers", zero).alias("n_numbers"))
    return j.where(F.col("n_lines") != F.col("n_numbers"))


@_query("""with l as (select query_symbol, max(observed_at) as newest from company_info_raw where body is not null group by all), m as (select max(newest) as m from l)
select query_symbol, date_diff('day', (newest at time zone 'UTC')::date, (m at time zone 'UTC')::date) as age_days, date_diff('day', (newest at time zone 'UTC')::date, (m at time zone 'UTC')::date) <= 90 as fresh from l, m where query_symbol is not null""")  # fmt: skip
def d36_freshness(spark, d):
    g = table(spark, d, "company_info_raw").where(F.col("body").isNotNull()).groupBy("query_symbol").agg(F.max("observed_at").alias("newest"))
    j = keys.with_one_row(g, g.agg(F.max("newest").alias("m"))).where(F.col("query_symbol").isNotNull())
    age = F.date_diff(F.to_date("m"), F.to_date("newest")).cast("long")
    return j.select("query_symbol", age.alias("age_days"), (age <= 90).alias("fresh"))


@_query("""select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by value desc, event_id) as rn from events) where rn <= 10""")
def t4_capped_details(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 10).select("user_id", "event_id", "event_type")


@_query("""select source_endpoint, source_bucket, metadata_hash, count(*) as n from filing_observations where metadata_hash is not null group by all having count(*) > 1""")
def k6_version_store_repeats(spark, d):
    g = table(spark, d, "filing_observations").where(F.col("metadata_hash").isNotNull()).groupBy("source_endpoint", "source_bucket", "metadata_hash").agg(_n().alias("n"))
    return g.where(F.col("n") > 1)


@_query("""with p as (select user_id, ts::date as day, sum(value::decimal(18,2)) as v from events group by all) select user_id, day, v, v - lag(v) over (partition by user_id order by day) as change from p""")
def w5_daily_series(spark, d):
    p = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
    return ordered.append_chain(p, ["user_id"], ["day"], "v").select("user_id", "day", F.col("v").cast("decimal(38,2)").alias("v"), (F.col("v") - F.col("previous_v")).cast("decimal(38,2)").alias("change"))


@_query("""with e as (select user_id, ts, event_id, case when event_type = 'view' then value end as open, case when event_type <> 'signup' then value end as last from events)
select user_id, count(*) as n_observations, count(distinct open) as n_opens, case count(distinct open) when 0 then 'none' when 1 then 'constant' else 'changed' end as open_state,
arg_min(open, (ts, event_id)) filter (where open is not null) as first_open, arg_min({'x': last}, (ts, event_id)).x as first_last, arg_min(open, (ts, event_id)) filter (where open is not null) = arg_min({'x': last}, (ts, event_id)).x as first_last_matches from e group by all""")  # fmt: skip
def w5_open_constancy(spark, d):
    """Whether a user's opening values stayed the same, and whether the first row's last value is the first opening value."""
    e = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_type") == "view", F.col("value")).alias("open"), F.when(F.col("event_type") != "signup", F.col("value")).alias("last"))
    n = F.count_distinct("open")
    g = e.groupBy("user_id").agg(_n().alias("n_observations"), n.alias("n_opens"), F.when(n == 0, "none").when(n == 1, "constant").otherwise("changed").alias("open_state"), F.min_by("open", F.when(F.col("open").isNotNull(), F.col("at"))).alias("first_open"), F.min_by(F.struct("last"), "at").getField("last").alias("first_last"))
    return g.withColumn("first_last_matches", F.col("first_open") == F.col("first_last"))
