"""Text helpers that no built-in expression offers, in Arrow batches."""

from __future__ import annotations

import calendar
import functools
import json
import re
import unicodedata
import urllib.parse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.instants import MONTHS
from tracewell.functions.keys import as_col

# What is printed for "nothing" and for "does not apply".
NIL_MARKS = ("-", "--", "- -", "–", "—")
NIL_WORDS = ("nil", "nill", "zero")
NOT_APPLICABLE = ("n/a", "na", "n.a.", "n.m.", "not applicable")


# Digits, word characters and blanks of any script, as Python's patterns have them.
_DIGIT, _WORD, _BLANK = r"\p{Nd}", r"\p{L}\p{N}_", r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def nfkc(c: str | Column) -> Column:
    """Unicode compatibility composition; null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return run(as_col(c))


def value_state(c: str | Column) -> Column:
    """numeric, reported_nil, nil_word, not_applicable, blank, percentage or not_a_number; null for null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def state(x):
            if x is None:
                return None
            t = unicodedata.normalize("NFKC", x).strip().lower()
            if not t:
                return "blank"
            if t in NIL_MARKS:
                return "reported_nil"
            if t in NIL_WORDS:
                return "nil_word"
            if t in NOT_APPLICABLE:
                return "not_applicable"
            if "%" in t or "per cent" in t:
                return "percentage"
            return "numeric" if re.search(r"\d", t) and not t.startswith("note") else "not_a_number"

        return s.map(state)

    return run(as_col(c))


def url_path(c: str | Column) -> Column:
    """A relative path percent-encoded, its slashes kept; null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else urllib.parse.quote(x, safe="/"))

    return run(as_col(c))


def field_paths(c: str | Column, pattern: str) -> Column:
    """Dotted paths of all fields of a JSON text, at any depth, whose name matches; list places are numbers.

    Null and texts that are no JSON have none.  The walk is a loop over a
    stack, so depth is limited by the parser only.
    """

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        want = re.compile(pattern, re.IGNORECASE)

        def paths(x):
            try:
                todo = [("", json.loads(x))] if x else []
            except (ValueError, RecursionError):
                return []
            found = []
            while todo:
                at, v = todo.pop()
                items = v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ()
                for k, w in items:
                    path = f"{at}.{k}" if at else str(k)
                    if isinstance(v, dict) and want.search(k):
                        found.append(path)
                    if isinstance(w, dict | list):
                        todo.append((path, w))
            return sorted(found)

        return s.map(paths)

    return run(as_col(c))


def accepted_path(c: str | Column) -> Column:
    """Why a stored document path cannot be an object key, or ``ok``; blanks inside a path are allowed and get encoded."""
    p = as_col(c)
    return (
        F.when(p.isNull(), "null")
        .when(p.rlike(rf"^{_BLANK}*$"), "blank")
        .when(p.rlike(rf"^{_BLANK}|{_BLANK}$"), "outer_white_space")
        .when(p.startswith("/") | p.contains("://") | p.contains("\\"), "not_relative")
        .when(p.rlike(r"[\x00-\x1f\x7f]"), "control_character")
        .when(p.rlike(r"(^|/)\.{0,2}(/|$)"), "empty_or_relative_segment")
        .when(p.endswith("."), "trailing_dot")
        .otherwise("ok")
    )


# The older prefix of document paths, and what stands before it in today's keys.
LEGACY_PREFIX, LEGACY_HOME = "upload_report_file/", "cmt/"


def path_candidates(c: str | Column) -> Column:
    """The keys to try for an accepted path, percent-encoded, in order: the path itself, then a legacy one under its new home."""
    p, encoded = as_col(c), url_path(c)
    both = F.when(p.startswith(LEGACY_PREFIX), F.array(encoded, F.concat(F.lit(LEGACY_HOME), encoded))).otherwise(F.array(encoded))
    return F.when(accepted_path(c) == "ok", both).otherwise(F.array().cast("array<string>"))


# Phrases of a period's length.
NUMBERS = {"three": 3, "six": 6, "nine": 9, "twelve": 12, "03": 3, "06": 6, "09": 9, "3": 3, "6": 6, "9": 9, "12": 12}
MONTHS_PHRASE = r"(?i)\b(three|six|nine|twelve|0?3|0?6|0?9|12)\s*-?\s*months?\b"
OTHER_PHRASES = ((r"(?i)\bquarter\b", 3, "quarter"), (r"(?i)\bhalf[\s-]+year\b", 6, "6M"), (r"(?i)\b(?:financial\s+)?year\s*(?:ended|ending)\b", 12, "12M"))
ANY_PERIOD = r"(?i)\bperiod\s+(?:ended|ending)\b"


def duration_phrase(c: str | Column) -> Column:
    """(months, label) of the first phrase of a duration in a text; (null, unspecified) for a bare period, null for none."""
    t = F.coalesce(as_col(c), F.lit(""))
    word = F.lower(F.regexp_extract(t, MONTHS_PHRASE, 1))
    months = F.coalesce(*[F.when(word == w, n) for w, n in NUMBERS.items()])
    at = lambda p: F.nullif(F.regexp_instr(t, F.lit(p)), F.lit(0))
    found = [F.struct(at(MONTHS_PHRASE).alias("at"), months.alias("months"), F.concat(months.cast("string"), F.lit("M")).alias("label"))]
    found += [F.struct(at(p).alias("at"), F.lit(n).alias("months"), F.lit(label).alias("label")) for p, n, label in OTHER_PHRASES]
    first = F.array_min(F.filter(F.array(*found), lambda f: f["at"].isNotNull()))
    unspecified = F.when(t.rlike(ANY_PERIOD), F.struct(F.lit(None).cast("int").alias("months"), F.lit("unspecified").alias("label")))
    return F.when(first.isNotNull(), F.struct(first["months"].alias("months"), first["label"].alias("label"))).otherwise(unspecified)


# Forms of dates in running text, the more telling first.  A day is not part of a longer number.
_MONTH = "(?P<m>" + "|".join(n if len(n) == 3 else f"{n[:3]}(?:{n[3:]})?" for n in MONTHS).replace("sep(?:tember)?", "sep(?:t(?:ember)?)?") + ")"
_DAY, _YEAR = r"(?<![\d.,/])(?P<d>\d{1,2})(?P<o>st|nd|rd|th)?", r"(?P<y>(?:19|20)\d{2})(?![\d/])"
DATE_FORMS = (
    ("full", rf"{_DAY}[\s.,\-]*{_MONTH}\b\.?,?[\s.,\-]*{_YEAR}"),
    ("full", rf"{_DAY}-{_MONTH}-(?P<y>\d{{2}})(?![\d/])"),
    ("full", rf"\b{_MONTH}\.?\s+(?P<d>\d{{1,2}})(?P<o>st|nd|rd|th)?,?\s+{_YEAR}"),
    ("full", r"(?<![\d.,/])(?P<d>\d{1,2})[./-](?P<n>\d{1,2})[./-](?P<y>(?:19|20)\d{2}|\d{2})(?![\d./])"),
    ("month_day", rf"{_DAY}[\s.\-]*{_MONTH}\b"),
    ("month_day", rf"\b{_MONTH}\.?\s+(?P<d>\d{{1,2}})(?P<o>st|nd|rd|th)?\b(?![,.]?\s*\d)"),
    ("year", r"(?<![\d.,/\-])(?P<y>(?:19|20)\d{2})(?![\d,/])"),
    ("year", r"(?<![\d.,/\-])(?P<y>2 0\d{2})(?![\d,/])"),
)


@functools.cache
def _date_forms() -> list[tuple[str, re.Pattern]]:
    return [(kind, re.compile(p, re.IGNORECASE)) for kind, p in DATE_FORMS]


def _days_in(year: int, month: int) -> int:
    """0 for no month."""
    return calendar.monthrange(year, month)[1] if 1 <= month <= 12 else 0


def date_tokens_of(text: str) -> list[dict]:
    """The date tokens of a text in reading order; see :func:`date_tokens`."""
    free, found = bytearray(b"\x01") * len(text), []
    for kind, form in _date_forms():
        for m in form.finditer(text):
            if 0 in free[m.start() : m.end()]:
                continue
            part = m.groupdict()
            year = int(part["y"].replace(" ", "")) if part.get("y") else None
            year = year + 2000 if year is not None and year < 100 else year
            month = int(part["n"]) if part.get("n") else next((i for i, n in enumerate(MONTHS, 1) if part.get("m") and n.startswith(part["m"][:3].lower())), None)
            day = int(part["d"]) if part.get("d") else None
            suffix = (part.get("o") or "").lower()
            misspelt = bool(suffix) and suffix != ("th" if day % 100 in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th"))
            real = misspelt or kind == "year" or (day >= 1 and day <= _days_in(2024 if kind == "month_day" else year, month) and (year is None or year > 0))
            if real:
                free[m.start() : m.end()] = bytes(m.end() - m.start())
                if not misspelt:
                    found.append({"start": m.start(), "kind": kind, "year": year, "month": month, "day": day, "text": m.group(0)})
    return sorted(found, key=lambda t: t["start"])


def date_tokens(c: str | Column) -> Column:
    """Every date in a text: (start, kind, year, month, day, text), kind full, month_day or year; null has none.

    Numeric dates are day first.  What the calendar does not have is no date;
    a day with the wrong ordinal ending (3st) is none either, and no other
    reading of it is tried.  Tokens do not overlap: full dates are found first,
    then days of a month, then years.
    """

    @F.pandas_udf("array<struct<start:int,kind:string,year:int,month:int,day:int,text:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [] if x is None else date_tokens_of(x))

    return run(as_col(c))


# A document path ends in <security id>_<epoch of 10 to 13 digits>.<extension>.
_PATH_END = r"(?:^|/)([0-9]+)_([0-9]{10,13})\.[A-Za-z0-9]+$"


def path_security(c: str | Column) -> Column:
    """The security id in a document path; null where the path has none."""
    return F.nullif(F.regexp_extract(as_col(c), _PATH_END, 1), F.lit(""))


def path_epoch(c: str | Column) -> Column:
    """Milliseconds since 1970 in a document path: 13 digits are milliseconds, 10 to 12 are seconds; null where there are none."""
    e = F.regexp_extract(as_col(c), _PATH_END, 2)
    return F.when(F.length(e) == 13, e.try_cast("long")).otherwise(e.try_cast("long") * 1000)


_APART = rf"(?<![{_WORD}.,/\-])"
# What counts as an amount or a percentage, in the order of replacement.  Each starts with a
# look at its first character, which rejects most places at once.
_AMOUNTS = (
    rf"(?=[(\-{_DIGIT}]){_APART}\(?-?{_DIGIT}{{1,3}}(?:,{_DIGIT}{{3}})+(?:\.{_DIGIT}+)?\)?(?![{_WORD},/\-])",
    rf"(?=[(\-{_DIGIT}]){_APART}\(?-?{_DIGIT}+\.{_DIGIT}+\)?%?(?![{_WORD}./\-])",
    rf"(?=[\-{_DIGIT}]){_APART}-?{_DIGIT}+(?:\.{_DIGIT}+)? ?%",
    rf"(?={_DIGIT}){_APART}{_DIGIT}{{5,}}(?![{_WORD}.,/\-])",
    rf"(?=[,.])(?:^|(?<= ))[,.]{_DIGIT}[{_DIGIT},.]*",
)


def redacted(c: str | Column) -> Column:
    """A whole text with its blanks collapsed, then amounts and percentages as ``#``; dates and years stay.  Null counts as empty."""
    out = F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), f"{_BLANK}+", " "))
    for p in _AMOUNTS:
        out = F.regexp_replace(out, p, "#")
    return out
