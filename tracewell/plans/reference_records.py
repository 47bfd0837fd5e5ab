"""Queries of fetches, printed values, periods, row checks, evidence loading and stored-result checks."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions import keys, listing, records
from tracewell.operators import ordered
from tracewell.plans.reference import _SOURCES, QUERIES, SQL, _query
from tracewell.sources.tables import table

__all__ = ["QUERIES", "SQL"]


def _n():
    return F.count(F.lit(1))


@_query("""select raw_id, case when b is null then 'network_error' when trim(b, e' \\t\\r\\n\\f') = '' then 'empty_response' when not json_valid(b) then 'invalid_json' when json_type(b::json) = 'OBJECT' then 'ok' else 'malformed_response' end as outcome
from (select raw_id, any_value(body) as b from company_info_raw group by raw_id)""")  # fmt: skip
def s2_fetch_outcomes(spark, d):
    """Bodies as answers of one endpoint; a body that is absent never arrived."""
    rows = table(spark, d, "company_info_raw").select("raw_id", "body").distinct()
    lost = F.when(F.col("body").isNull(), "network")
    return rows.select("raw_id", records.fetch_outcome(lost, F.lit(200), F.lit("companyInfoSummery"), "body").alias("outcome"))


@_query("""select raw_id, coalesce(json_type(b) = 'OBJECT', false) as is_summary, coalesce(json_type(b) = 'ARRAY' or (json_type(b) = 'OBJECT' and len(list_filter(json_keys(b), lambda k: json_type(json_extract(b, '$."' || k || '"')) = 'ARRAY')) > 0), false) as is_trades
from (select raw_id, try_cast(any_value(body) as json) as b from company_info_raw group by raw_id)""")  # fmt: skip
def s3_body_shapes(spark, d):
    rows = table(spark, d, "company_info_raw").select("raw_id", "body").distinct()
    return rows.select("raw_id", records.shape_ok(F.lit("companyInfoSummery"), "body").alias("is_summary"), records.shape_ok(F.lit("tradeSummary"), "body").alias("is_trades"))


@_query("""with e as (select snapshot_no, coalesce(nullif(json_extract_string(raw_item::json, '$.symbol'), ''), nullif(json_extract_string(raw_item::json, '$.Symbol'), ''), nullif(json_extract_string(raw_item::json, '$.securityCode'), '')) as symbol, (taken_at, cse_filing_id, raw_item) as pos, cse_filing_id from listing_snapshots)
select snapshot_no, symbol, arg_min(cse_filing_id, pos) as first_id, count(*) > 1 as repeated from e where symbol is not null group by all""")  # fmt: skip
def s6_rows_by_symbol(spark, d):
    """The first row of each symbol of a payload, and whether the symbol comes again."""
    v = F.try_parse_json("raw_item")
    symbol = F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in ("symbol", "Symbol", "securityCode")])
    rows = table(spark, d, "listing_snapshots").select("snapshot_no", symbol.alias("symbol"), F.struct("taken_at", "cse_filing_id", "raw_item").alias("at"), "cse_filing_id").where(F.col("symbol").isNotNull())
    return rows.groupBy("snapshot_no", "symbol").agg(F.min_by("cse_filing_id", "at").alias("first_id"), (_n() > 1).alias("repeated"))


@_query("""with v as (select distinct f5_run_id, statement_index, row_index, column_index, label_raw, currency, value_id, raw_value from reported_values),
s as (select distinct f5_run_id, statement_index from v), r as (select f5_run_id, statement_index, row_index, min(label_raw) as label from v group by all), c as (select f5_run_id, statement_index, column_index, min(currency) as column_currency from v group by all)
select v.value_id, r.label, c.column_currency, v.raw_value from v join s using (f5_run_id, statement_index) join r using (f5_run_id, statement_index, row_index) join c using (f5_run_id, statement_index, column_index)""")  # fmt: skip
def s16_statements_rebuilt(spark, d):
    """Statements, rows, columns and cells, held apart, joined to what was printed."""
    v = table(spark, d, "reported_values").select("f5_run_id", "statement_index", "row_index", "column_index", "label_raw", "currency", "value_id", "raw_value").distinct()
    at = ["f5_run_id", "statement_index"]
    r = v.groupBy(*at, "row_index").agg(F.min("label_raw").alias("label"))
    c = v.groupBy(*at, "column_index").agg(F.min("currency").alias("column_currency"))
    cells = v.select(*at, "row_index", "column_index", "value_id", "raw_value")
    return cells.join(v.select(*at).distinct(), at).join(r, [*at, "row_index"]).join(c, [*at, "column_index"]).select("value_id", "label", "column_currency", "raw_value")


_ISSUER = r"nullif(lower(regexp_replace(issuer_id, '^[\s{]+|[\s}]+$', '', 'g')), '')"


@_query(f"""with own as (select distinct {_ISSUER} as issuer, cse_filing_id from issuer_decisions where {_ISSUER} is not null), runs as (select distinct f5_run_id, cse_filing_id, document_sha256 from extraction_runs),
docs as (select distinct issuer, document_sha256 from own join runs using (cse_filing_id)),
wide as (select issuer, f5_run_id from own join runs using (cse_filing_id) union select issuer, f5_run_id from docs join runs using (document_sha256))
select issuer, count(*) as n_runs from wide group by all""")  # fmt: skip
def s17_evidence_superset(spark, d):
    """All runs of an issuer's filings, and all runs of those filings' documents wherever they were filed."""
    own = table(spark, d, "issuer_decisions").select(keys.uuid_key("issuer_id").alias("issuer"), "cse_filing_id").where(F.col("issuer").isNotNull()).distinct()
    runs = table(spark, d, "extraction_runs").select("f5_run_id", "cse_filing_id", "document_sha256").distinct()
    direct = own.join(runs, "cse_filing_id").select("issuer", "f5_run_id", "document_sha256")
    shared = direct.select("issuer", "document_sha256").distinct().join(runs, "document_sha256").select("issuer", "f5_run_id")
    return direct.select("issuer", "f5_run_id").unionByName(shared).distinct().groupBy("issuer").agg(_n().alias("n_runs"))


@_query("select c_custkey, coalesce(n.name, c_name) as c_name, n.name is not null as replaced from customer left join (select o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) as name from orders group by all) n on n.o_custkey = c_custkey")
def k2_full_row_upsert(spark, d):
    """Held rows replaced as a whole by the batch's latest row of their key; the table is derived again, not changed in place."""
    held = table(spark, d, "customer").select("c_custkey", "c_name")
    batch = ordered.latest_per_key(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("name"))
    return held.join(batch, "c_custkey", "left").select("c_custkey", F.coalesce("name", "c_name").alias("c_name"), F.col("name").isNotNull().alias("replaced"))


@_query("select source_symbol, min(source_name) as name from filings where source_name is not null and trim(source_name) <> '' and source_symbol not in (select source_symbol from issuers where identity_basis = 'cse_sec_id') group by all")
def k4_named_inserts(spark, d):
    """Symbols without a confirmed master row, where the source supplies a name; none is made up."""
    rows = table(spark, d, "filings").where(F.col("source_name").isNotNull() & (F.trim("source_name") != ""))
    return rows.join(table(spark, d, "issuers").where(F.col("identity_basis") == "cse_sec_id").select("source_symbol"), "source_symbol", "left_anti").groupBy("source_symbol").agg(F.min("source_name").alias("name"))


@_query("select l_returnflag as flag, case when l_returnflag in ('1', 'true', 'True', 'Y', 'y') then true when l_returnflag in ('0', 'false', 'False', 'N', 'n') then false end as active, count(*) as n from lineitem group by all")
def f5_tri_state(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), records.tri_state("l_returnflag").alias("active")).agg(_n().alias("n"))


@_query("select delivery_no from filings where uploaded_at >= timestamptz '2023-12-31 18:30:00+00' and uploaded_at < timestamptz '2024-12-31 18:30:00+00'")
def f8_window_membership(spark, d):
    """Uploads of the local days of 2024; the bounds are literals and reach the scan."""
    first, end = records.local_days("2024-01-01", "2024-12-31")
    return table(spark, d, "filings").where((F.col("uploaded_at") >= first) & (F.col("uploaded_at") < end)).select("delivery_no")


_REASONS = """reasons as (select id, list_filter([case when status <> 'evidenced' then 'issuer_evidence_' || status end, case when basis = 'none' then 'issuer_basis_none' end, case when issuer_id is null then 'issuer_absent' end, case when decided_at >= timestamptz '2025-01-01 00:00:00+00' then 'late_decision' end], lambda x: x is not null) as r from (select distinct * from issuer_decisions))"""


def _decision_reasons(spark, d) -> DataFrame:
    x = table(spark, d, "issuer_decisions").distinct()
    r = F.array_compact(F.array(F.when(F.col("status") != "evidenced", F.concat(F.lit("issuer_evidence_"), F.col("status"))), F.when(F.col("basis") == "none", "issuer_basis_none"), F.when(F.col("issuer_id").isNull(), "issuer_absent"), F.when(F.col("decided_at") >= F.to_timestamp(F.lit("2025-01-01 00:00:00+00:00")), "late_decision")))
    return x.select("id", r.alias("r"))


@_query("with " + _REASONS + " select id, len(r) > 0 and len(list_filter(r, lambda x: not starts_with(x, 'issuer_'))) = 0 as issuer_only from reasons")
def f11_issuer_only(spark, d):
    """Refused, and for issuer reasons alone; no reason at all is no refusal."""
    return _decision_reasons(spark, d).select("id", ((F.size("r") > 0) & F.forall("r", lambda x: x.startswith("issuer_"))).alias("issuer_only"))


@_query("select delivery_no, len(list_filter(source_buckets, lambda x: x not in ('annual', 'quarterly'))) = 0 as contained, coalesce(list_contains(source_buckets, 'annual'), false) as has_annual from filings")
def f14_containment(spark, d):
    both = F.array(F.lit("annual"), F.lit("quarterly"))
    return table(spark, d, "filings").select("delivery_no", (F.size(F.array_except("source_buckets", both)) == 0).alias("contained"), F.array_contains("source_buckets", "annual").alias("has_annual"))


@_query("with " + _REASONS + " select id, array_to_string(list_filter(r, lambda x: x not in ('issuer_basis_none')) || list_filter(r, lambda x: x = 'late_decision'), ',') as refusal from reasons where len(r) > 0")
def f16_refusal_reasons(spark, d):
    """Reasons that are not lifted, in order and with repeats, then those of a second rule."""
    rows = _decision_reasons(spark, d).where(F.size("r") > 0)
    left = F.concat(F.filter("r", lambda x: x != "issuer_basis_none"), F.filter("r", lambda x: x == "late_decision"))
    return rows.select("id", F.array_join(left, ",").alias("refusal"))


_BARS = """bars as (select user_id, ts::date as day, max(value)::decimal(18,2) as high, min(value)::decimal(18,2) as low, arg_max(value, (ts, event_id))::decimal(18,2) as close, sum((json_extract_string(props, '$.k'))::bigint - 5) as volume from events group by all),
prev as (select *, last_value(close ignore nulls) over (partition by user_id order by day rows between unbounded preceding and 1 preceding) as before from bars)"""


@_query("with " + _BARS + """ select user_id, day, array_to_string(list_filter([case when high < low then 'high_below_low' end, case when close < low or close > high then 'close_outside_range' end, case when high <= 0 or low <= 0 or close <= 0 then 'non_positive_price' end, case when volume < 0 then 'negative_volume' end,
case when before <> 0 and abs(close - before) * 100 > 30 * abs(before) then 'large_move' end], lambda x: x is not null), ',') as notes from prev""")  # fmt: skip
def d2_row_validation(spark, d):
    """Daily bars against named predicates and the previous close; a row without notes is sound."""
    price = lambda c: c.cast("decimal(18,2)")
    bars = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(price(F.max("value")).alias("high"), price(F.min("value")).alias("low"), price(F.max_by("value", F.struct("ts", "event_id"))).alias("close"), F.sum(F.get_json_object("props", "$.k").cast("long") - 5).alias("volume"))
    bars = ordered.previous_value(bars, ["user_id"], ["day"], "close", "before")
    c, h, lo, b = (F.col(x) for x in ("close", "high", "low", "before"))
    notes = F.array_compact(F.array(F.when(h < lo, "high_below_low"), F.when((c < lo) | (c > h), "close_outside_range"), F.when((h <= 0) | (lo <= 0) | (c <= 0), "non_positive_price"), F.when(F.col("volume") < 0, "negative_volume"), F.when((b != 0) & (F.abs(c - b) * 100 > 30 * F.abs(b)), "large_move")))
    return bars.select("user_id", "day", F.array_join(notes, ",").alias("notes"))


def _like(pattern: str) -> str:
    return "regexp_matches(t, '" + pattern.replace("'", "''") + "')"


_CLASS_SQL = "case when t = '' then 'text' " + " ".join(
    f"when {_like(p)} then {k}" for p, k in (
        (records.DASHES, "'dash_nil'"), ("(?i)" + records.SHEET_ERROR, "'spreadsheet_error'"), (records.DATE_LIKE, "'text'"), (records.PLAIN, "'numeric'"), (records.PARENTHESES, "case when regexp_matches(t, '[1-9]') then 'parenthesised_negative' else 'negative_zero' end"),
        (records.MINUS, "case when regexp_matches(t, '[1-9]') then 'minus_negative' else 'negative_zero' end"), (records.PERCENT, "'percentage'"), (records.UNBALANCED_PERCENT, "'unresolved'"), (records.BOUND, "'comparison_bound'"), (records.NUMBER_MARKS, "'unresolved'"),
    )
) + " else 'text' end"


@_query(f"select raw_value, {_CLASS_SQL} as printed_class, n from (select raw_value, trim(coalesce(raw_value, '')) as t, count(*) as n from reported_values group by all)")
def x1_printed_classes(spark, d):
    # Each distinct text is read once.
    n = table(spark, d, "reported_values").groupBy("raw_value").agg(_n().alias("n"))
    return n.select("raw_value", records.printed_class("raw_value").alias("printed_class"), "n")


@_query(f"""with c as (select *, {_CLASS_SQL} as k from (select raw_value, parsed_value, trim(coalesce(raw_value, '')) as t, count(*) as n from reported_values group by all))
select raw_value, parsed_value, case when k in ('numeric', 'negative_zero') then case when parsed_value is null then 'inconsistent_input' else 'numeric' end when k in ('parenthesised_negative', 'minus_negative') then case when parsed_value < 0 then 'numeric' else 'inconsistent_input' end
when k = 'dash_nil' and parsed_value is not null then 'inconsistent_input' when t = '' then 'blank' when regexp_matches(replace(t, ' ', ''), '^[-–—−]{{1,2}}$') then 'reported_nil' when lower(t) in ('nil', 'none') then 'reported_nil_word' when lower(t) in ('n/a', 'na', 'n.a', 'n.a.', 'not applicable') then 'reported_not_applicable'
when k in ('percentage', 'comparison_bound', 'spreadsheet_error') then 'not_an_amount' else 'not_a_number' end as state, n from c""")  # fmt: skip
def x10_value_states(spark, d):
    """The eight states of a printed value: a nil is never a number, and a class that the stored number contradicts is inconsistent."""
    n = table(spark, d, "reported_values").groupBy("raw_value", "parsed_value").agg(_n().alias("n"))
    t, k, v = F.trim(F.coalesce("raw_value", F.lit(""))), records.printed_class("raw_value"), F.col("parsed_value")
    state = (
        F.when(k.isin("numeric", "negative_zero"), F.when(v.isNull(), "inconsistent_input").otherwise("numeric"))
        .when(k.isin(*records.NEGATIVES), F.when(v < 0, "numeric").otherwise("inconsistent_input"))
        .when((k == "dash_nil") & v.isNotNull(), "inconsistent_input")
        .when(t == "", "blank").when(F.replace(t, F.lit(" "), F.lit("")).rlike(records.DASHES), "reported_nil")
        .when(F.lower(t).isin("nil", "none"), "reported_nil_word").when(F.lower(t).isin("n/a", "na", "n.a", "n.a.", "not applicable"), "reported_not_applicable")
        .when(k.isin("percentage", "comparison_bound", "spreadsheet_error"), "not_an_amount").otherwise("not_a_number")
    )
    return n.select("raw_value", "parsed_value", state.alias("state"), "n")


_MONTHS = "[3, 6, 9, 12, 5, null][(o_custkey % 6 + 1)::int]"


@_query(f"""with p as (select o_orderkey, last_day(o_orderdate::date) as e, {_MONTHS} as m, case when o_orderstatus = 'F' then 3 when o_orderstatus = 'O' then 12 end as fm from orders), k as (select *, (month(e) - fm + 12) % 12 as a from p)
select o_orderkey, case when m is null then 'unspecified' when m in (3, 6, 9, 12) then m || 'm' else 'other_' || m || 'm' end as period_class,
case when m = 3 then case a when 3 then 'Q1' when 6 then 'Q2' when 9 then 'Q3' when 0 then 'Q4' end when m = 6 then case a when 6 then 'H1' when 0 then 'H2' end when m = 9 then case a when 9 then '9M' end when m = 12 then case a when 0 then 'FY' end end as fiscal_label from k""")  # fmt: skip
def x6_period_classes(spark, d):
    """Periods that end with an order's month; its customer decides their length, its status when the fiscal year ends."""
    m = F.element_at(F.array(*[F.lit(x).cast("int") for x in (3, 6, 9, 12, 5, None)]), (F.col("o_custkey") % 6 + 1).cast("int"))
    p = table(spark, d, "orders").select("o_orderkey", F.last_day(F.to_date("o_orderdate")).alias("e"), m.alias("m"), F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 12).alias("fm"))
    return p.select("o_orderkey", records.period_class(F.lit("duration"), F.col("m")).alias("period_class"), records.fiscal_label(F.col("e"), F.col("m"), F.col("fm")).alias("fiscal_label"))


@_query("""with s as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_returnflag when 'A' then 'group' when 'N' then 'company' end as scope, bool_or(l_returnflag = 'A') over (partition by l_orderkey) as beside from lineitem)
select l_orderkey, case when scope = 'group' then 'consolidated' when scope = 'company' and beside then 'separate' else 'unresolved' end as canonical_scope, count(*) as n from s group by all""")  # fmt: skip
def x8_canonical_scope(spark, d):
    """A company column is the separate one only beside a group column of the same statement; nothing is assumed."""
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "A").alias("g"), F.count_if(F.col("l_returnflag") == "N").alias("c"), _n().alias("n"))
    zero = F.lit(0).cast("long")
    separate = F.when(F.col("g") > 0, F.col("c")).otherwise(zero)
    rows = per.select("l_orderkey", F.inline(F.array(*[F.struct(F.lit(k).alias("canonical_scope"), v.alias("n")) for k, v in (("consolidated", F.col("g")), ("separate", separate), ("unresolved", F.col("n") - F.col("g") - separate))])))
    return rows.where(F.col("n") > 0)


@_query("""with v as (select distinct value_id, parsed_value::varchar::decimal(24,4) as p, reported_scale as s, coalesce(printed_decimals, 0) as dp, upper(trim(currency)) as c, value_type from reported_values),
r as (select *, list_filter([case when p is null then 'value_not_numeric' end, case when c is null then 'currency_not_reported' when not regexp_matches(c, '^[A-Z]{3}$') then 'currency_unrecognised' end, case when s is null then 'scale_not_reported' when value_type = 'per_share_amount' and s <> 1 then 'per_share_scale_not_unit' end], lambda x: x is not null) as why from v)
select value_id, array_to_string(why, ',') as reasons, case when len(why) = 0 then (p * s::decimal(12,0))::decimal(38,4) end as normalized, case when len(why) = 0 then (s::decimal(38,4) / 2 / pow(10, dp))::decimal(38,4) end as half_unit from r""")  # fmt: skip
def x11_normalised_values(spark, d):
    """Number times scale, exact, with half a printed unit; every reason why not is named and nothing is assumed."""
    v = table(spark, d, "reported_values").select("value_id", F.col("parsed_value").cast("string").cast("decimal(24,4)").alias("p"), F.col("reported_scale").alias("s"), F.coalesce("printed_decimals", F.lit(0)).alias("dp"), F.upper(F.trim("currency")).alias("c"), "value_type").distinct()
    why = F.array_compact(F.array(F.when(F.col("p").isNull(), "value_not_numeric"), F.when(F.col("c").isNull(), "currency_not_reported").when(~F.col("c").rlike("^[A-Z]{3}$"), "currency_unrecognised"), F.when(F.col("s").isNull(), "scale_not_reported").when((F.col("value_type") == "per_share_amount") & (F.col("s") != 1), "per_share_scale_not_unit")))
    v = v.withColumn("why", why)
    sound = lambda c: F.when(F.size("why") == 0, c.cast("decimal(38,4)"))
    unit = F.element_at(F.array(*[F.lit(10**k) for k in range(10)]), F.col("dp") + 1)
    return v.select("value_id", F.array_join("why", ",").alias("reasons"), sound(F.col("p") * F.col("s").cast("decimal(12,0)")).alias("normalized"), sound(F.col("s").cast("decimal(30,4)") / (2 * unit)).alias("half_unit"))


@_query(f"""with p as (select o_orderkey, case o_orderstatus when 'F' then 'instant' when 'O' then 'duration' end as k, case when o_orderpriority like '1%' then null else o_orderdate::date end as st, last_day(o_orderdate::date) as e, {_MONTHS} as m, case when o_orderpriority like '5%' then null else date '2000-06-30' end as pub from orders)
select o_orderkey, array_to_string(list_filter([case when k is null then 'period_kind_missing' end, case when k = 'instant' and m is not null then 'instant_with_duration' end, case when k = 'instant' and st is not null then 'instant_with_start' end,
case when k = 'duration' then case when m is null then 'duration_months_missing' when st > e then 'period_start_after_end' when st <> (e + interval 1 day - to_months(m))::date then 'period_start_inconsistent_with_duration' end end,
case when pub is null then 'publication_date_not_supplied' when e > pub then 'period_end_after_publication' end], lambda x: x is not null), ',') as reasons from p""")  # fmt: skip
def x14_period_reasons(spark, d):
    day = F.to_date("o_orderdate")
    m = F.element_at(F.array(*[F.lit(x).cast("int") for x in (3, 6, 9, 12, 5, None)]), (F.col("o_custkey") % 6 + 1).cast("int"))
    p = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "instant").when(F.col("o_orderstatus") == "O", "duration").alias("k"), F.when(~F.col("o_orderpriority").startswith("1"), day).alias("st"), F.last_day(day).alias("e"), m.alias("m"), F.when(~F.col("o_orderpriority").startswith("5"), F.lit("2000-06-30").cast("date")).alias("pub"))
    return p.select("o_orderkey", F.array_join(records.period_reasons(*[F.col(c) for c in ("k", "st", "e", "m", "pub")]), ",").alias("reasons"))


@_query("select f5_run_id from (select distinct f5_run_id from extraction_runs where f5_run_id is not null) order by sha256('verify-7|' || f5_run_id), f5_run_id limit 40")
def t6_verify_sample(spark, d):
    """Forty runs to prove again, chosen by a seeded hash."""
    runs = table(spark, d, "extraction_runs").where(F.col("f5_run_id").isNotNull()).select("f5_run_id").distinct()
    return ordered.rotating_sample(runs, "verify-7", "f5_run_id", 40)


@_query("select l_orderkey, median(l_partkey) as median_part, median(l_suppkey) as median_supplier from lineitem group by all")
def a24_group_medians(spark, d):
    rows = table(spark, d, "lineitem")
    of = lambda c, n: ordered.order_statistics(rows.select("l_orderkey", c), "l_orderkey", c).select("l_orderkey", F.col("median").alias(n))
    return of("l_partkey", "median_part").join(of("l_suppkey", "median_supplier"), "l_orderkey")


_COUNTERS = {
    "values": "true", "numbers": "representation_class = 'number'", "with_unit": "representation_class = 'number_with_unit'", "percentages": "representation_class = 'percentage'", "nils": "representation_class = 'dash_nil'", "texts": "representation_class = 'not_a_number'",
    "per_share": "value_type = 'per_share_amount'", "scaled": "reported_scale > 1", "unscaled": "reported_scale = 1", "scale_unknown": "reported_scale is null", "currency_unknown": "currency is null", "negative": "sign_as_printed <> 'positive'", "unparsed": "parsed_value is null", "conflicting": "scale_basis = 'statement_scale_conflicting'",
}


@_query("select " + ", ".join(f"count(*) filter (where {c}) as n_{k}" for k, c in _COUNTERS.items()) + " from (select distinct * from reported_values)")
def a15_value_counters(spark, d):
    """Fourteen counters in one pass."""
    v = table(spark, d, "reported_values").distinct()
    return v.agg(*[F.count_if(F.expr(c)).alias(f"n_{k}") for k, c in _COUNTERS.items()])


@_query("select (observed_at at time zone 'UTC' + interval 330 minute)::date as local_day, count(*) as used, greatest(0, 3000 - count(*)) as budget_left, count(*) > 3000 as over_budget from filing_observations group by all")
def a23_budget_per_day(spark, d):
    n = _n()
    return table(spark, d, "filing_observations").groupBy(F.to_date(F.from_utc_timestamp("observed_at", "+05:30")).alias("local_day")).agg(n.alias("used"), F.greatest(F.lit(0).cast("long"), 3000 - n).alias("budget_left"), (n > 3000).alias("over_budget"))


_AT = "case when regexp_full_match({0}, '-?[0-9]+') then {0}::bigint * 1000 else epoch_us(try_strptime({0}, '%d %b %Y %I:%M:%S %p') - interval 330 minute) end"
_SAID = "said as (" + " union all ".join(f"select cse_filing_id, ep, bk, qs, '{k}' as kind, {_AT.format('json_extract_string(raw_item::json, ' + chr(39) + '$.' + k + chr(39) + ')')} as t from sources where list_contains(json_keys(raw_item::json), '{k}')" for k in ("uploadedDate", "authorizedDate")) + ")"


@_query("with " + _SOURCES + ", " + _SAID + """,
effective as (select *, case when (t + 19800000000) % 86400000000 = 0 then t + 86399999999 else t end as eff, (t + 19800000000) % 86400000000 = 0 as day from said),
changed as (select distinct cse_filing_id from (select cse_filing_id, ep, bk, qs, kind from said group by all having count(distinct coalesce(t, -1)) > 1)),
apart as (select distinct cse_filing_id from (select cse_filing_id, kind, max(t) filter (where ep = 'getfinancialannouncement') as fh, min(t) filter (where ep = 'getfinancialannouncement') as fl, max(t) filter (where ep = 'financials') as lh, min(t) filter (where ep = 'financials') as ll from said group by all) where greatest(fh - ll, lh - fl) >= 1000000)
select e.cse_filing_id, max(eff) as available_us, bool_and(day) filter (where eff = (select max(x.eff) from effective x where x.cse_filing_id = e.cse_filing_id)) as day_only, bool_or(c.cse_filing_id is not null) as changed, bool_or(a.cse_filing_id is not null) as disagree
from effective e left join changed c on c.cse_filing_id = e.cse_filing_id left join apart a on a.cse_filing_id = e.cse_filing_id group by all""")  # fmt: skip
def d21_filing_availability(spark, d):
    """When a filing was public: the latest of its stated instants, a date alone counting to the end of its local day; whether a source changed one, and whether feed and listing are a second or more apart."""
    item = F.from_json("raw_item", "map<string,string>")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.map_contains_key("item", F.lit(k)).alias("has"), F.element_at("item", F.lit(k)).alias("text")) for k in ("uploadedDate", "authorizedDate")])
    rows = table(spark, d, "filing_observations").select("cse_filing_id", listing.endpoint_name("source_endpoint").alias("ep"), listing.bucket_name("source_bucket").alias("bk"), F.coalesce("query_symbol", F.lit("")).alias("qs"), item.alias("item"))
    said = rows.select("cse_filing_id", "ep", "bk", "qs", F.inline(kinds)).where("has").withColumn("at", listing.instant_micros("text"))
    day_us, offset = 86_400_000_000, 19_800_000_000
    midnight = F.pmod(F.col("at") + offset, F.lit(day_us)) == 0
    eff = F.when(midnight, F.col("at") + (day_us - 1)).otherwise(F.col("at"))
    per = said.groupBy("cse_filing_id", "ep", "bk", "qs", "kind").agg(F.count_distinct(F.coalesce("at", F.lit(-1).cast("long"))).alias("k"), F.max("at").alias("hi"), F.min("at").alias("lo"), F.max(F.when(F.col("at").isNotNull(), F.struct(eff.alias("eff"), (~midnight).alias("exact")))).alias("top"))
    feed, own = F.col("ep") == "getfinancialannouncement", F.col("ep") == "financials"
    of = lambda f, cond, c: f(F.when(cond, F.col(c)))
    kind = per.groupBy("cse_filing_id", "kind").agg(F.max("top").alias("top"), F.bool_or(F.col("k") > 1).alias("changed"), of(F.max, feed, "hi").alias("fh"), of(F.min, feed, "lo").alias("fl"), of(F.max, own, "hi").alias("lh"), of(F.min, own, "lo").alias("ll"))
    apart = F.coalesce(F.greatest(F.col("fh") - F.col("ll"), F.col("lh") - F.col("fl")) >= 1_000_000, F.lit(False))
    out = kind.groupBy("cse_filing_id").agg(F.max("top").alias("top"), F.bool_or("changed").alias("changed"), F.bool_or(apart).alias("disagree"))
    return out.select("cse_filing_id", F.col("top.eff").alias("available_us"), (~F.col("top.exact")).alias("day_only"), "changed", "disagree")


_LINKS = r"nullif(lower(regexp_replace({0}, '^[\s{{]+|[\s}}]+$', '', 'g')), '')"


@_query(f"""with first as (select cse_filing_id, min(observed_at) as at from filing_observations group by all), cls as (select {_LINKS.format('id')} as id, min(classified_at) as at from classifications group by all), dec as (select cse_filing_id, arg_max(decided_at, id) as at from issuer_decisions group by all),
r as (select distinct * from extraction_runs)
select r.f5_run_id, case when first.at is not null and cls.at is not null and r.document_retrieved_at is not null then epoch_us(greatest(first.at, cls.at, coalesce(dec.at, cls.at), r.recorded_at, r.document_retrieved_at, coalesce(r.path_epoch_at, r.recorded_at))) end as known_at_us,
array_to_string(list_filter([case when first.at is null then 'first_observation' end, case when cls.at is null then 'classification' end, case when r.document_retrieved_at is null then 'document' end], lambda x: x is not null), ',') as missing
from r left join first on first.cse_filing_id = r.cse_filing_id left join cls on cls.id = {_LINKS.format('r.classification_id')} left join dec on dec.cse_filing_id = r.cse_filing_id""")  # fmt: skip
def d22_knowledge_chain(spark, d):
    """When a run's result was known: the latest time of its whole chain of records, never if a needed link is missing; the missing ones by name."""
    first = table(spark, d, "filing_observations").groupBy("cse_filing_id").agg(F.min("observed_at").alias("_first"))
    cls = table(spark, d, "classifications").groupBy(keys.uuid_key("id").alias("_cls")).agg(F.min("classified_at").alias("_classified"))
    dec = table(spark, d, "issuer_decisions").groupBy("cse_filing_id").agg(F.max_by("decided_at", "id").alias("_decided"))
    r = table(spark, d, "extraction_runs").distinct().withColumn("_cls", keys.uuid_key("classification_id"))
    j = r.join(first, "cse_filing_id", "left").join(cls, "_cls", "left").join(dec, "cse_filing_id", "left")
    missing = F.array_compact(F.array(F.when(F.col("_first").isNull(), "first_observation"), F.when(F.col("_classified").isNull(), "classification"), F.when(F.col("document_retrieved_at").isNull(), "document")))
    at = F.greatest("_first", "_classified", "_decided", "recorded_at", "document_retrieved_at", "path_epoch_at")
    return j.select("f5_run_id", F.when(F.size(missing) == 0, F.unix_micros(at)).alias("known_at_us"), F.array_join(missing, ",").alias("missing"))


_STAGES = ("observed", "listed", "classified", "confirmed", "decided", "evidenced", "retrieved", "extracted", "reported")
_FUNNEL = """ids as (select distinct cse_filing_id as id from filing_observations where cse_filing_id is not null),
r as (select id, [true, id in (select cse_filing_id from filings), id in (select cse_filing_id from classifications), id in (select cse_filing_id from classifications where document_type_status in ('confirmed', 'document_only')), id in (select cse_filing_id from issuer_decisions), id in (select cse_filing_id from issuer_decisions where status = 'evidenced'),
id in (select cse_filing_id from extraction_runs where document_retrieved_at is not null), id in (select cse_filing_id from extraction_runs), id in (select cse_filing_id from reported_values)] as s from ids),
reached as (select id, coalesce(list_position(s, false) - 1, 9) as k from r)"""


@_query("with " + _FUNNEL + ", t as (select unnest([" + ", ".join(f"'{s}'" for s in _STAGES) + "]) as stage, unnest(range(1, 10)) as i) select stage, count(*) filter (where k >= i) as n_reached, count(*) filter (where k = i) as n_stopped from t, reached group by stage, i")
def d27_coverage_funnel(spark, d):
    """Nine stages; a filing stops at the first one it lacks, whatever it has beyond."""
    f = table(spark, d, "filing_observations").select(F.col("cse_filing_id").alias("id")).where(F.col("id").isNotNull()).distinct()
    c, x, r = (table(spark, d, t) for t in ("classifications", "issuer_decisions", "extraction_runs"))
    parts = {
        "listed": table(spark, d, "filings"), "classified": c, "confirmed": c.where(F.col("document_type_status").isin("confirmed", "document_only")), "decided": x, "evidenced": x.where(F.col("status") == "evidenced"),
        "retrieved": r.where(F.col("document_retrieved_at").isNotNull()), "extracted": r, "reported": table(spark, d, "reported_values"),
    }
    # One aggregation over all of them, so a filing is shuffled once per table and not once per stage.
    has = [rows.select(F.col("cse_filing_id").alias("id"), F.lit(i).alias("s")).where(F.col("id").isNotNull()).distinct() for i, rows in enumerate(parts.values(), 1)]
    marks = functools.reduce(DataFrame.unionByName, [f.withColumn("s", F.lit(0)), *has]).groupBy("id").agg(F.sum(F.expr("shiftleft(1, s)")).alias("m")).where(F.col("m") % 2 == 1)
    reached = F.lit(len(_STAGES))
    for i in reversed(range(len(_STAGES))):
        reached = F.when(F.col("m").bitwiseAND(F.lit(1 << i)) == 0, F.lit(i)).otherwise(reached)
    per = marks.groupBy(reached.alias("k")).agg(_n().alias("n"))
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(i).alias("i")) for i, s in enumerate(_STAGES, 1)])
    zero = F.lit(0).cast("long")
    return per.select("k", "n", F.inline(stages)).groupBy("stage").agg(F.sum(F.when(F.col("k") >= F.col("i"), F.col("n")).otherwise(zero)).alias("n_reached"), F.sum(F.when(F.col("k") == F.col("i"), F.col("n")).otherwise(zero)).alias("n_stopped"))


_ANOMALIES = {
    "path_missing": "path is null", "path_blank": "trim(path) = ''", "path2_differs": "path2 is not null and path2 <> path", "listing_only": "len_buckets > 0 and source_name is null", "feed_only": "len_symbols = 0", "upload_date_only": "(up_us + 19800000000) % 86400000000 = 0", "authorized_missing": "authorized_at is null",
    "authorized_before_upload": "authorized_at < uploaded_at", "uploaded_after_last_seen": "uploaded_at > last_seen_at", "seen_before_first": "last_seen_at < first_seen_at", "manual_date_missing": "manual_date_raw is null", "several_symbols": "len_symbols > 1", "several_buckets": "len_buckets > 1", "name_missing": "source_name is null", "title_blank": "trim(file_text) = ''",
}


@_query("with f as (select *, len(listing_symbols) as len_symbols, len(source_buckets) as len_buckets, epoch_us(uploaded_at) as up_us from filings) " + " union all ".join(f"select '{k}' as kind, count(*) as n from f where {c}" for k, c in _ANOMALIES.items()))
def d28_anomaly_catalogue(spark, d):
    """Every kind is counted in one pass; kinds nobody shows count 0."""
    f = table(spark, d, "filings").withColumns({"len_symbols": F.size("listing_symbols"), "len_buckets": F.size("source_buckets"), "up_us": F.unix_micros("uploaded_at")})
    one = f.agg(*[F.count_if(F.expr(c)).alias(k) for k, c in _ANOMALIES.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in _ANOMALIES])))


_CHECKS_SQL = {
    "run_id_unique": "select count(*), count(*) filter (where n > 1) from (select f5_run_id, count(*) as n from (select distinct * from extraction_runs) group by all)",
    "stored_hash_recomputed": "select count(*), 0 from filing_observations where metadata_hash is not null",
    "one_output_per_input": "select count(*), count(*) filter (where n > 1) from (select document_sha256, mapper_version, count(distinct classification_id) as n from extraction_runs group by all)",
    "cells_unique": "select count(*), count(*) filter (where n > 1) from (select f5_run_id, statement_index, row_index, column_index, count(distinct value_id) as n from reported_values group by all)",
    "classified_document_is_extracted": "select count(*), count(*) filter (where not ok) from (select document_sha256, document_sha256 in (select document_sha256 from extraction_runs) as ok from (select distinct document_sha256 from classifications))",
    "decision_after_filing_seen": "select count(*), count(*) filter (where d.decided_at < f.seen) from (select distinct * from issuer_decisions) d join (select cse_filing_id, min(first_seen_at) as seen from filings group by all) f using (cse_filing_id)",
}


@_query(" union all ".join(f"select '{k}' as check_name, * from ({q}) t(n_checked, n_failed)" for k, q in _CHECKS_SQL.items()))
def d33_verification_suite(spark, d):
    """Stored results proved again from what they were made of: per check how many were proved and how many failed."""
    t = lambda name: table(spark, d, name)
    repeated = lambda rows, by, n: rows.groupBy(*by).agg(n.alias("n")).select((F.col("n") > 1).alias("bad"))
    runs, filings = t("extraction_runs"), t("filings").groupBy("cse_filing_id").agg(F.min("first_seen_at").alias("seen"))
    known = runs.select("document_sha256").distinct().withColumn("ok", F.lit(True))
    parts = {
        "run_id_unique": repeated(runs.distinct(), ["f5_run_id"], _n()),
        "stored_hash_recomputed": t("filing_observations").where(F.col("metadata_hash").isNotNull()).select((keys.bare("metadata_hash") != F.sha2(listing.raw_content("raw_item"), 256)).alias("bad")),
        "one_output_per_input": repeated(runs, ["document_sha256", "mapper_version"], F.count_distinct("classification_id")),
        "cells_unique": repeated(t("reported_values"), ["f5_run_id", "statement_index", "row_index", "column_index"], F.count_distinct("value_id")),
        "classified_document_is_extracted": t("classifications").select("document_sha256").distinct().join(known, "document_sha256", "left").select(F.col("ok").isNull().alias("bad")),
        "decision_after_filing_seen": t("issuer_decisions").distinct().join(filings, "cse_filing_id").select((F.col("decided_at") < F.col("seen")).alias("bad")),
    }
    out = [rows.agg(_n().alias("n_checked"), F.count_if("bad").alias("n_failed")).select(F.lit(k).alias("check_name"), "*") for k, rows in parts.items()]
    return functools.reduce(DataFrame.unionByName, out)


@_query("""with e as (select user_id, ts::date as day, bool_or(hour(ts) >= 12) as eod, bool_or(hour(ts) < 12) as early from events group by all), n as (select count(distinct user_id) as n from events), d as (select unnest(range((select min(day) from e), (select max(day) from e) + interval 3 day, interval 1 day))::date as day)
select d.day, count(*) filter (where eod) as n_eod, case when d.day > (select max(day) from e) then 'unknown' when dayofweek(d.day) in (0, 6) then 'not_applicable' when count(*) filter (where eod) = 0 then 'missing' when count(*) filter (where eod) = (select n from n) then 'complete' else 'partial' end as state from d left join e on e.day = d.day group by d.day""")  # fmt: skip
def d3_completeness_states(spark, d):
    """All five states over a calendar: days after the last observation are unknown, week-ends not applicable."""
    e = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.bool_or(F.hour("ts") >= 12).alias("eod"))
    per = e.groupBy("day").agg(F.count_if("eod").alias("n_eod"))
    whole = e.agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count_distinct("user_id").alias("n_expected"))
    days = whole.select("b", "n_expected", F.explode(F.sequence("a", F.date_add("b", 2))).alias("day"))
    n = F.coalesce("n_eod", F.lit(0).cast("long"))
    state = F.when(F.col("day") > F.col("b"), "unknown").when(F.dayofweek("day").isin(1, 7), "not_applicable").when(n == 0, "missing").when(n == F.col("n_expected"), "complete").otherwise("partial")
    return days.join(per, "day", "left").select("day", n.alias("n_eod"), state.alias("state"))


@_query("with " + _SOURCES + " select min(delivery_no) as first_delivery, count(*) as n_deliveries, cse_filing_id, ep, bk from sources group by cse_filing_id, ep, bk, content")
def k6_version_store(spark, d):
    """One row per version of a listing entry: filing, endpoint, bucket and content."""
    rows = table(spark, d, "filing_observations").select("delivery_no", "cse_filing_id", listing.endpoint_name("source_endpoint").alias("ep"), listing.bucket_name("source_bucket").alias("bk"), F.sha2(listing.raw_content("raw_item"), 256).alias("h"))
    return rows.groupBy("cse_filing_id", "ep", "bk", "h").agg(F.min("delivery_no").alias("first_delivery"), _n().alias("n_deliveries")).drop("h")


@_query("""with i as (select distinct snapshot_no, taken_at, cse_filing_id, raw_item from listing_snapshots), t as (select *, """ + _AT.format("json_extract_string(raw_item::json, '$.uploadedDate')") + """ as up, json_extract_string(raw_item::json, '$.manualDate') as manual from i)
select snapshot_no, count(*) as n_rows, max(up) as latest_us, ((make_timestamp(max(up)) + interval 330 minute)::date = (max(taken_at) at time zone 'UTC' + interval 330 minute)::date) as shows_its_day, count(*) filter (where manual is null) as n_missing, count(*) filter (where manual = '-19800000') as n_placeholder from t group by all""")  # fmt: skip
def f4_snapshot_evidence(spark, d):
    """What a snapshot itself shows of its day: its latest upload against the local day it was taken, and how many dates are absent or placeholders."""
    item = F.from_json("raw_item", "map<string,string>")
    t = table(spark, d, "listing_snapshots").select("snapshot_no", "taken_at", "cse_filing_id", "raw_item").distinct().withColumn("m", item)
    t = t.withColumns({"up": listing.instant_micros(F.try_element_at("m", F.lit("uploadedDate"))), "manual": F.try_element_at("m", F.lit("manualDate"))})
    day = lambda c: F.to_date(F.from_utc_timestamp(c, "+05:30"))
    return t.groupBy("snapshot_no").agg(_n().alias("n_rows"), F.max("up").alias("latest_us"), (day(F.timestamp_micros(F.max("up"))) == day(F.max("taken_at"))).alias("shows_its_day"), F.count_if(F.col("manual").isNull()).alias("n_missing"), F.count_if(F.col("manual") == "-19800000").alias("n_placeholder"))


@_query("""with f as (select cse_filing_id, arg_min(path, delivery_no) as p, arg_min(file_text, delivery_no) as t, arg_min(source_name, delivery_no) as n from (select *, 1 from filings) group by all),
o as (select cse_filing_id, json_extract_string(arg_max(raw_item, (snapshot_no, taken_at, raw_item))::json, '$.path') as p, json_extract_string(arg_max(raw_item, (snapshot_no, taken_at, raw_item))::json, '$.fileText') as t, json_extract_string(arg_max(raw_item, (snapshot_no, taken_at, raw_item))::json, '$.name') as n from listing_snapshots group by all)
select cse_filing_id, coalesce(f.p, o.p) as path, coalesce(f.t, o.t) as file_text, coalesce(f.n, o.n) as name, array_to_string(list_filter([case when f.p <> o.p then 'path' end, case when f.t <> o.t then 'file_text' end, case when f.n <> o.n then 'name' end], lambda x: x is not null), ',') as differing from f left join o using (cse_filing_id)""".replace("arg_min(path, delivery_no)", "arg_min({'x': path}, delivery_no).x").replace("arg_min(file_text, delivery_no)", "arg_min({'x': file_text}, delivery_no).x").replace("arg_min(source_name, delivery_no)", "arg_min({'x': source_name}, delivery_no).x"))  # fmt: skip
def f3_two_source_merge(spark, d):
    """One source with a fallback per field, and the fields in which both say something and differ."""
    first = table(spark, d, "filings").groupBy("cse_filing_id").agg(F.min_by(F.struct(F.col("path").alias("p"), F.col("file_text").alias("t"), F.col("source_name").alias("n")), "delivery_no").alias("f"))
    item = F.from_json(F.max_by("raw_item", F.struct("snapshot_no", "taken_at", "raw_item")), "path string, fileText string, name string")
    other = table(spark, d, "listing_snapshots").groupBy("cse_filing_id").agg(item.alias("o"))
    j = first.join(other, "cse_filing_id", "left")
    names = {"path": ("f.p", "o.path"), "file_text": ("f.t", "o.fileText"), "name": ("f.n", "o.name")}
    differing = F.array_compact(F.array(*[F.when(F.col(a) != F.col(b), k) for k, (a, b) in names.items()]))
    return j.select("cse_filing_id", *[F.coalesce(a, b).alias(k) for k, (a, b) in names.items()], F.array_join(differing, ",").alias("differing"))


@_query("""with reached as (select f.cse_filing_id, case when c.cse_filing_id is null then 'not_classified' when not c.ok then 'period_undetermined' when e.cse_filing_id is null then 'not_extracted' end as stop from (select distinct cse_filing_id from filings) f
left join (select cse_filing_id, bool_or(document_type_status in ('confirmed', 'document_only')) as ok from classifications group by all) c on c.cse_filing_id = f.cse_filing_id left join (select distinct cse_filing_id from extraction_runs) e on e.cse_filing_id = f.cse_filing_id)
select stop, coalesce(stop in ('not_classified', 'not_extracted'), false) as operational, count(*) as n from reached group by all""")  # fmt: skip
def f12_operational_stops(spark, d):
    """Where filings stop, and whether that is a matter of operation and not of a rule's own refusal."""
    c = table(spark, d, "classifications").groupBy("cse_filing_id").agg(F.bool_or(F.col("document_type_status").isin("confirmed", "document_only")).alias("ok"))
    e = table(spark, d, "extraction_runs").select("cse_filing_id").distinct().withColumn("x", F.lit(True))
    f = table(spark, d, "filings").select("cse_filing_id").distinct().join(c, "cse_filing_id", "left").join(e, "cse_filing_id", "left")
    stop = F.when(F.col("ok").isNull(), "not_classified").when(~F.col("ok"), "period_undetermined").when(F.col("x").isNull(), "not_extracted")
    return f.groupBy(stop.alias("stop")).agg(_n().alias("n")).select("stop", F.coalesce(F.col("stop").isin("not_classified", "not_extracted"), F.lit(False)).alias("operational"), "n")


@_query(f"""with r as (select distinct f5_run_id, cse_filing_id, document_sha256, {_LINKS.format('classification_id')} as k from extraction_runs), c as (select {_LINKS.format('id')} as k, min(cse_filing_id) as f, min(document_sha256) as s from classifications group by all)
select r.f5_run_id, case when r.k is null then 'no_reference' when c.k is null then 'missing' when c.f <> r.cse_filing_id then 'foreign_filing' when c.s <> r.document_sha256 then 'foreign_document' else 'own' end as verdict from r left join c using (k)""")  # fmt: skip
def d33c_ownership_guard(spark, d):
    """Whether what a run refers to belongs to the run's own filing and document."""
    c = table(spark, d, "classifications").groupBy(keys.uuid_key("id").alias("k")).agg(F.min("cse_filing_id").alias("f"), F.min("document_sha256").alias("s"), F.lit(True).alias("there")).where(F.col("k").isNotNull())
    r = table(spark, d, "extraction_runs").select("f5_run_id", "cse_filing_id", "document_sha256", keys.uuid_key("classification_id").alias("k")).distinct().join(c, "k", "left")
    verdict = F.when(F.col("k").isNull(), "no_reference").when(F.col("there").isNull(), "missing").when(F.col("f") != F.col("cse_filing_id"), "foreign_filing").when(F.col("s") != F.col("document_sha256"), "foreign_document").otherwise("own")
    return r.select("f5_run_id", verdict.alias("verdict"))


@_query("""with r as (select distinct f5_run_id, document_sha256, builder_version, mapper_version, recorded_at from extraction_runs), n as (select *, list_filter([case when builder_version not in ('f5.4') then 'builder_not_accepted' end, case when mapper_version not in ('m2', 'm3') then 'mapper_not_accepted' end, case when recorded_at is null then 'recorded_at_missing' end], lambda x: x is not null) as why from r),
top as (select document_sha256, max((recorded_at, f5_run_id)) as best from n where len(why) = 0 group by all)
select f5_run_id, case when len(why) > 0 then array_to_string(why, ',') when (recorded_at, f5_run_id) = best then 'selected' else 'older' end as verdict from n left join top using (document_sha256)""")  # fmt: skip
def d17_run_verdicts(spark, d):
    """Every run: selected for its document, older than that, or why it is not accepted."""
    r = table(spark, d, "extraction_runs").select("f5_run_id", "document_sha256", "builder_version", "mapper_version", "recorded_at").distinct()
    why = F.array_compact(F.array(F.when(~F.col("builder_version").isin("f5.4"), "builder_not_accepted"), F.when(~F.col("mapper_version").isin("m2", "m3"), "mapper_not_accepted"), F.when(F.col("recorded_at").isNull(), "recorded_at_missing")))
    r = r.withColumns({"why": why, "at": F.struct("recorded_at", "f5_run_id")})
    top = r.where(F.size("why") == 0).groupBy("document_sha256").agg(F.max("at").alias("best"))
    verdict = F.when(F.size("why") > 0, F.array_join("why", ",")).when(F.col("at") == F.col("best"), "selected").otherwise("older")
    return r.join(top, "document_sha256", "left").select("f5_run_id", verdict.alias("verdict"))


@_query("""with v as (select cse_filing_id, document_sha256 as sha, min(cdn_last_modified) as t, count(*) filter (where cdn_last_modified is null) as lacks from (select distinct * from extraction_runs) group by all),
f as (select cse_filing_id, count(*) as n, sum(lacks) as lacks, max(t) as newest, count(*) - count(distinct t) as ties from v group by all)
select v.cse_filing_id, v.sha, case when f.n = 1 then 'only' when f.lacks > 0 then 'ambiguous:time_unknown' when f.ties > 0 then 'ambiguous:same_time' when v.t = f.newest then 'current' else 'superseded' end as state from v join f using (cse_filing_id)""")  # fmt: skip
def d23_supersession_states(spark, d):
    """Versions of a filing in strict order of availability; with an unknown or equal time nothing is dropped."""
    v = table(spark, d, "extraction_runs").distinct().groupBy("cse_filing_id", F.col("document_sha256").alias("sha")).agg(F.min("cdn_last_modified").alias("at"), F.count_if(F.col("cdn_last_modified").isNull()).alias("lacks"))
    f = v.groupBy("cse_filing_id").agg(_n().alias("n"), F.sum("lacks").alias("all_lacks"), F.max("at").alias("newest"), (_n() - F.count_distinct("at")).alias("ties"))
    state = F.when(F.col("n") == 1, "only").when(F.col("all_lacks") > 0, "ambiguous:time_unknown").when(F.col("ties") > 0, "ambiguous:same_time").when(F.col("at") == F.col("newest"), "current").otherwise("superseded")
    return v.join(f, "cse_filing_id").select("cse_filing_id", "sha", state.alias("state"))


def _said_sql(rows: str) -> str:
    return f"select cse_filing_id, concat_ws('~', " + ", ".join(f"coalesce(json_extract(raw_item::json, '$.{k}')::varchar, '-')" for k in ("authorizedDate", "fileText", "id", "manualDate", "name", "path", "path2", "symbol", "uploadedDate")) + f") as content from {rows}"


@_query("with s as (select distinct * from (" + _said_sql("listing_snapshots") + ")), o as (select distinct * from (" + _said_sql("filing_observations") + """)), ids as (select cse_filing_id, bool_or(side = 's') as l, bool_or(side = 'o') as r from (select cse_filing_id, 's' as side from s union all select cse_filing_id, 'o' from o) group by all)
select case when not r then 'listed_only' when not l then 'observed_only' when exists (select 1 from s join o using (cse_filing_id, content) where s.cse_filing_id = ids.cse_filing_id) then 'same_content' else 'content_differs' end as verdict, count(*) as n from ids group by all""")  # fmt: skip
def d38_archive_verdicts(spark, d):
    """Two stores of the same entries against each other, both ways and by content."""
    def entries(name, side):
        return table(spark, d, name).select("cse_filing_id", F.sha2(listing.raw_content("raw_item"), 256).alias("h"), F.lit(side).alias("side"))

    both = entries("listing_snapshots", 1).unionByName(entries("filing_observations", 2))
    per = both.groupBy("cse_filing_id", "h").agg(F.bit_or("side").alias("m")).groupBy("cse_filing_id").agg(F.bit_or("m").alias("any"), F.max("m").alias("most"))
    verdict = F.when(F.col("any") == 1, "listed_only").when(F.col("any") == 2, "observed_only").when(F.col("most") == 3, "same_content").otherwise("content_differs")
    return per.groupBy(verdict.alias("verdict")).agg(_n().alias("n"))
