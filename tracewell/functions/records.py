"""Column expressions over fetches, printed values and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.keys import as_col

# Statuses that mean a block.
BLOCKED = (401, 403, 407, 451)
# Kinds of transport error that decide the outcome by themselves, and the outcome.
TRANSPORT = {"timeout": "timeout", "too_large": "too_large", "network": "network_error"}
# What reads as true and as false.
TRUE, FALSE = ("1", "true", "True", "Y", "y"), ("0", "false", "False", "N", "n")

# A printed number, dashes that print as minus, and the marks of the other classes.
_CORE = r"(?:[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?|\.[0-9]+)"
_MINUS = "-–−"
DASHES = rf"^[{_MINUS}—]{{1,2}}$"
SHEET_ERROR = r"^#(?:REF!|DIV/0!|VALUE!|N/A|NAME\?|NUM!|NULL!)$"
DATE_LIKE = r"^[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}|[0-9]{4})$"
PLAIN = rf"^\+?{_CORE}$"
PARENTHESES = rf"^\(\s*{_CORE}\s*\)$"
MINUS = rf"^[{_MINUS}]\s?{_CORE}$"
PERCENT = rf"^(?:[{_MINUS}]?\s*{_CORE}\s*%\s*|\(\s*{_CORE}\s*(?:\)\s*%\s*|%\s*\)))$"
UNBALANCED_PERCENT = rf"^(?:[{_MINUS}]|\()?\s*{_CORE}\s*\)?\s*%\s*\)?$"
BOUND = rf"^(?:[<>]=?|≥|≤)\s*(?:[{_MINUS}]?\s*{_CORE}|\(\s*{_CORE}\s*\))\s*%?$"
NUMBER_MARKS = rf"^[{_MINUS}—0-9,.()%+<>\s]*[0-9][{_MINUS}—0-9,.()%+<>\s]*$"
AMOUNTS = ("numeric", "parenthesised_negative", "minus_negative", "negative_zero")
NEGATIVES = ("parenthesised_negative", "minus_negative")


def tri_state(c: str | Column) -> Column:
    """true, false, or null for whatever reads as neither."""
    return F.when(as_col(c).isin(*TRUE), True).when(as_col(c).isin(*FALSE), False)


def parse_status(body: str | Column) -> Column:
    """``empty``, ``not_json`` or ``json_ok``; null without a body."""
    b = as_col(body)
    return F.when(b.isNull(), None).when(F.length(F.btrim(b, F.lit(" \t\r\n\f"))) == 0, "empty").when(F.try_parse_json(b).isNull(), "not_json").otherwise("json_ok")


def shape_ok(endpoint: str | Column, body: str | Column) -> Column:
    """Whether a parsed body has its endpoint's shape; an unknown endpoint has none.

    companyInfoSummery: an object; tradeSummary: a list, or an object with a
    list among its values; allSecurityCode: such a list with a symbol in it.
    """
    v, e = F.try_parse_json(as_col(body)), as_col(endpoint)
    members = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    as_list = lambda x: F.try_variant_get(x, "$", "array<variant>")
    rows = F.coalesce(as_list(v), F.get(F.filter(F.transform(members, as_list), lambda x: x.isNotNull()), F.lit(0)))
    named = F.exists(rows, lambda r: F.coalesce(*[F.nullif(F.try_variant_get(r, f"$.{k}", "string"), F.lit("")) for k in ("symbol", "Symbol", "securityCode")]).isNotNull())
    right = F.when(e == "companyInfoSummery", members.isNotNull()).when(e == "tradeSummary", rows.isNotNull()).when(e == "allSecurityCode", named)
    return F.coalesce(right, F.lit(False))


def fetch_outcome(error_kind: str | Column, status: str | Column, endpoint: str | Column, body: str | Column) -> Column:
    """What one attempt came to; the first rule that applies decides."""
    k, s, p = as_col(error_kind), as_col(status), parse_status(body)
    out = F.when(k == "timeout", TRANSPORT["timeout"])
    for kind, name in TRANSPORT.items():
        out = out.when(k == kind, name)
    out = out.when(s.isin(*BLOCKED), "blocked").when(s == 429, "rate_limited").when(s.between(500, 599), "server_error").when(s.between(300, 399), "unexpected_redirect")
    out = out.when(~F.coalesce(s.between(200, 299), F.lit(False)), "http_error").when(p == "empty", "empty_response").when(p == "not_json", "invalid_json")
    return out.when(~shape_ok(endpoint, body), "malformed_response").otherwise("ok")


def retry_after_seconds(header: str | Column, now: str | Column) -> Column:
    """Seconds that a Retry-After header asks for: a whole number, or an HTTP date (not before now); null if it is neither."""
    h = F.trim(as_col(header))
    date = F.regexp_extract(h, r"^[A-Za-z]{3},\s+([0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2})\s+(?:GMT|UTC|\+0000)$", 1)
    at = F.to_utc_timestamp(F.try_to_timestamp(F.nullif(date, F.lit("")), F.lit("d MMM yyyy HH:mm:ss")), F.current_timezone())
    left = (F.unix_micros(at) - F.unix_micros(as_col(now))) / 1_000_000
    return F.when(h.rlike("^[0-9]+$"), h.try_cast("double")).otherwise(F.greatest(F.when(at.isNotNull(), F.lit(0.0)), left))


def printed_class(c: str | Column) -> Column:
    """How a value is printed: one of ten classes, by rules in a fixed order; null counts as empty text."""
    t = F.trim(F.coalesce(as_col(c), F.lit("")))
    zero = ~t.rlike("[1-9]")
    return (
        F.when(t == "", "text")
        .when(t.rlike(DASHES), "dash_nil")
        .when(F.upper(t).rlike(SHEET_ERROR), "spreadsheet_error")
        .when(t.rlike(DATE_LIKE), "text")
        .when(t.rlike(PLAIN), "numeric")
        .when(t.rlike(PARENTHESES), F.when(zero, "negative_zero").otherwise("parenthesised_negative"))
        .when(t.rlike(MINUS), F.when(zero, "negative_zero").otherwise("minus_negative"))
        .when(t.rlike(PERCENT), "percentage")
        .when(t.rlike(UNBALANCED_PERCENT), "unresolved")
        .when(t.rlike(BOUND), "comparison_bound")
        .when(t.rlike(NUMBER_MARKS), "unresolved")
        .otherwise("text")
    )


def printed_number(c: str | Column) -> Column:
    """The number of a value of an amount class or a percentage, signed and exact; null for other classes and beyond 32 digits."""
    k, t = printed_class(c), F.trim(as_col(c))
    n = F.regexp_replace(F.regexp_extract(t, f"({_CORE})", 1), ",", "").try_cast("decimal(38,6)")
    negative = k.isin(*NEGATIVES) | ((k == "percentage") & t.rlike(rf"^[{_MINUS}(]"))
    return F.when(k.isin(*AMOUNTS, "percentage"), F.when(negative, -n).otherwise(n))


def printed_decimals(c: str | Column) -> Column:
    """Decimal places printed; null where there is no number."""
    core = F.regexp_extract(F.trim(as_col(c)), f"({_CORE})", 1)
    return F.when(printed_class(c).isin(*AMOUNTS, "percentage"), F.length(F.regexp_extract(core, r"\.([0-9]+)$", 1)))


def period_class(kind: Column, months: Column) -> Column:
    """3m, 6m, 9m, 12m, other_<n>m or unspecified of a duration; null for an instant."""
    whole = F.when(F.coalesce(months, F.lit(0)) == 0, "unspecified").when(months.isin(3, 6, 9, 12), F.concat(months.cast("string"), F.lit("m"))).otherwise(F.concat(F.lit("other_"), months.cast("string"), F.lit("m")))
    return F.when(kind == "duration", whole)


def fiscal_label(end: Column, months: Column, year_end_month: Column) -> Column:
    """Q1 to Q4, H1, H2, 9M or FY of a period that ends with its month, by the month in which the fiscal year ends; else null."""
    after = F.pmod(F.month(end) - year_end_month, F.lit(12))
    named = lambda pairs: F.coalesce(*[F.when(after == k, n) for k, n in pairs])
    label = F.when(months == 3, named(((3, "Q1"), (6, "Q2"), (9, "Q3"), (0, "Q4")))).when(months == 6, named(((6, "H1"), (0, "H2")))).when(months == 9, named(((9, "9M"),))).when(months == 12, named(((0, "FY"),)))
    return F.when((end == F.last_day(end)) & year_end_month.between(1, 12), label)


def period_reasons(kind: Column, start: Column, end: Column, months: Column, published: Column) -> Column:
    """Why a stated period cannot be one, in a fixed order; an empty array if it can."""
    instant, duration = kind == "instant", kind == "duration"
    expected = F.add_months(F.date_add(end, 1), -months)
    return F.array_compact(F.array(
        F.when(kind.isNull(), "period_kind_missing").when(~kind.isin("instant", "duration"), "period_kind_invalid"),
        F.when(end.isNull(), "period_end_missing"),
        F.when(instant & months.isNotNull(), "instant_with_duration"),
        F.when(instant & start.isNotNull(), "instant_with_start"),
        F.when(duration & months.isNull(), "duration_months_missing").when(duration & (months <= 0), "duration_months_invalid")
        .when(duration & (start > end), "period_start_after_end").when(duration & (start != expected), "period_start_inconsistent_with_duration"),
        F.when(published.isNull(), "publication_date_not_supplied").when(end > published, "period_end_after_publication"),
    ))


def local_days(first: str, last: str, offset: str = "+05:30") -> tuple[Column, Column]:
    """Half-open bounds of local days as instants; literals, so a comparison reaches the scan."""
    day = lambda d: F.to_utc_timestamp(d, offset)
    utc = lambda c: F.to_utc_timestamp(c, F.current_timezone())
    return utc(day(F.to_timestamp(F.lit(f"{first} 00:00:00")))), utc(day(F.to_timestamp(F.lit(f"{last} 00:00:00")) + F.expr("interval 1 day")))
