"""Texts that mean an instant, in many forms and zones, as one UTC instant.

An ordered cascade of anchored patterns; the first whose whole text matches
decides.  Parsing is strict: every field is checked by constructing the local
date and time, so 31 February or 25:61 is no instant.  Zone: one in the text,
else the sender's zone from a lookup column, else the default.  Local readings
that occur twice or never in their zone are refused (or resolved, by policy).
All of it is column expressions inside whole-stage code generation.
"""

from __future__ import annotations

import functools
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.keys import BLANKS

DEFAULT_ZONE = "Asia/Colombo"

# English names of months and weekdays.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# Abbreviations beside the first three letters.
_ALSO = ("sept", "tues", "thur", "thurs")


def _names(full: tuple[str, ...]) -> str:
    """A pattern of names, in full or abbreviated; longer ones first."""
    return "(?:" + "|".join(sorted({*full, *(n[:3] for n in full), *(a for a in _ALSO if any(n.startswith(a) for n in full))}, key=lambda n: (-len(n), n))) + ")"


_MON, _WEEKDAY = _names(MONTHS), _names(WEEKDAYS)

# Zone abbreviations with one meaning here, as minutes east of UTC.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "aest": 600, "aedt": 660, "acst": 570, "acdt": 630, "awst": 480, "nzst": 720, "nzdt": 780, "jst": 540, "sgt": 480, "slst": 330, "sst": 330,
}

_ZONE = r"(?:z|[a-z]{2,4}|(?:utc|gmt)?[+\-−]\d{1,2}(?::?\d{2})?)"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([ap])\.?m\.?)?"

# (name, pattern, group numbers of: year month day hour minute second fraction half zone weekday)
_CASCADE = (
    ("compact", r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", (1, 2, 3, 4, 5, 6, 0, 0, 0, 0)),
    ("iso", rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[t\s]\s*{_CLOCK}{_HALF})?(?:\s*({_ZONE}))?$", (1, 2, 3, 4, 5, 6, 7, 8, 9, 0)),
    ("named", rf"^(?:({_WEEKDAY})\.?,?\s+)?(\d{{1,2}})[\s\-/.]+({_MON})\.?[\s\-/.,]+(\d{{4}})(?:[\s,]+{_CLOCK}{_HALF})?(?:\s*({_ZONE}))?$", (4, 3, 2, 5, 6, 7, 8, 9, 10, 1)),
    ("month_first", rf"^(?:({_WEEKDAY})\.?,?\s+)?({_MON})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?:[\s,]+{_CLOCK}{_HALF})?(?:\s*({_ZONE}))?$", (4, 2, 3, 5, 6, 7, 8, 9, 10, 1)),
    ("day_first", rf"^(\d{{1,2}})([/.\-])(\d{{1,2}})\2(\d{{4}})(?:[\s,]+{_CLOCK}{_HALF})?(?:\s*({_ZONE}))?$", (4, 3, 1, 5, 6, 7, 8, 9, 10, 0)),
    ("run_together", rf"^(\d{{1,2}})({_MON})(\d{{4}})(\d{{2}})(\d{{2}})(\d{{2}})\s*({_ZONE})?$", (3, 2, 1, 4, 5, 6, 0, 0, 7, 0)),
)

_UNIX = r"^([+-]?\d{1,13}|[+-]?\d{15,17})(?:\.(\d{1,9}))?$"
_DAY_US = 86_400_000_000


# More partitions than any table has.
_EVERY = 1 << 24


def _cut(df: DataFrame) -> DataFrame:
    """The same rows: coalescing into more partitions than there are shuffles nothing, but ends the method that is generated.

    Where blocks have locations a few partitions may share a task.  The JVM leaves methods of more than 8,000 bytes uncompiled, and everything
    below in one would be several times as long.
    """
    return df.coalesce(_EVERY)


def _number_of(c: Column, names: tuple[str, ...]) -> Column:
    """From 1, the name that begins with the first three letters."""
    at = F.instr(F.lit("".join(f",{n[:3]}" for n in names)), F.concat(F.lit(","), F.substring(c, 1, 3)))
    return F.when(at > 0, F.call_function("div", at + 3, F.lit(4)).cast("int"))


# Stands before the fields of a form that matched.
_MATCHED = "\u0001"


def _with_fields(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fields of the first matching form as an array of ten texts; null if no form matches.

    Each form is tried once, by the replacement that also extracts, in a
    projection of its own, and only where none before it matched.
    """
    df = df.withColumn(out, F.col(text))
    for _name, pattern, groups in _CASCADE:
        layout = _MATCHED + "|".join(f"${n}" if n else "" for n in groups)
        df = df.withColumn(out, F.when(F.col(out).startswith(_MATCHED), F.col(out)).otherwise(F.regexp_replace(out, pattern, layout)))
    return df.withColumn(out, F.when(F.col(out).startswith(_MATCHED), F.split(F.substring(F.col(out), 2, 200), r"\|", -1)))


def _offset_minutes(zone: Column, clock: Column) -> Column:
    """Minutes east of UTC of a zone text whose digits are ``clock`` (h, hh or hhmm, as a number of hhmm); null when it names none we know."""
    named = F.try_element_at(F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair]), zone)
    hours, minutes = F.call_function("div", clock, F.lit(100)).cast("int"), clock % 100
    signed = F.when((clock < 1900) & (minutes < 60), F.when(zone.contains("-"), -1).otherwise(1) * (hours * 60 + minutes))
    return F.coalesce(named, signed)


def unix_micros_by_size(s: Column) -> Column:
    """Plain digits as Unix time: seconds, milliseconds or microseconds by size."""
    whole = F.split_part(s, F.lit("."), F.lit(1)).try_cast("long")
    part = F.substring(F.rpad(F.split_part(s, F.lit("."), F.lit(2)), 6, "0"), 1, 6).try_cast("long") * F.when(F.substring(s, 1, 1) == "-", -1).otherwise(1)
    size = F.abs(whole)
    return (
        F.when(~s.rlike(_UNIX), None)
        .when(size < 100_000_000_000, whole * 1_000_000 + part)
        .when(size < 100_000_000_000_000, whole * 1_000 + (part / 1000).cast("long"))
        .otherwise(whole)
    )


def with_utc_micros(df: DataFrame, text: str, zone_hint: str | None, out: str, default_zone: str = DEFAULT_ZONE, ambiguous: str = "refuse") -> DataFrame:
    """``df`` with ``out``: microseconds since 1970 UTC that ``text`` means, or null.

    Case and outer blanks do not matter.  Plain digits are Unix time by size,
    except 14 digits (yyyymmddhhmmss).  Slashed, dotted and dashed dates are
    day first; a date alone is the start of that day.  A zone or offset in the
    text wins over ``zone_hint``, which wins over ``default_zone``; an unknown
    zone text or hint makes the text unusable.  A local reading that occurs
    twice in its zone is refused, or is the ``"first"`` or ``"second"``
    occurrence by policy; one that never occurs is always refused.  Null and
    empty texts give null.  A weekday must be one, and the date's.
    """
    columns = [c for c in df.columns if c != out]
    # The row's own columns travel as one value, so none of their names can clash.
    df = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(text).alias("_text"), (F.col(zone_hint) if zone_hint else F.lit(None).cast("string")).alias("_hint"))
    df = df.withColumn("_s", F.translate(F.lower(F.btrim("_text", F.lit(BLANKS))), "\u2212\u0001", "-"))
    df = _cut(_with_fields(df, "_s", "_f"))
    part = lambda n: F.nullif(F.col("_f")[n], F.lit(""))
    number = lambda n: part(n).try_cast("int")
    df = df.withColumns({"_y": number(0), "_mt": part(1), "_dd": number(2), "_h": number(3), "_mi": F.coalesce(number(4), F.lit(0)), "_se": F.coalesce(number(5), F.lit(0)), "_half": part(7), "_zone": part(8), "_wd": part(9)})
    df = df.withColumns({
        "_fr": F.substring(F.rpad(F.coalesce(part(6), F.lit("0")), 6, "0"), 1, 6).try_cast("int"),
        "_mo": F.coalesce(F.col("_mt").try_cast("int"), _number_of(F.col("_mt"), MONTHS)),
        "_h": F.when(F.col("_h").isNull(), F.lit(0)).when(F.col("_half").isNull(), F.col("_h")).when(F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_half") == "p", 12).otherwise(0)),
    })
    df = df.withColumn("_day", F.unix_date(F.try_make_timestamp_ntz("_y", "_mo", "_dd", F.lit(0), F.lit(0), F.lit(0)).cast("date")).cast("long"))
    clock = ((F.col("_h") * 60 + F.col("_mi")) * 60 + F.col("_se")).cast("long") * 1_000_000 + F.col("_fr")
    # 1 January 1970 was a Thursday.
    named = F.col("_wd").isNull() | (_number_of(F.col("_wd"), WEEKDAYS) == F.pmod(F.col("_day") + 3, F.lit(7)) + 1)
    sound = (F.col("_y") >= 1) & (F.col("_h") < 24) & (F.col("_mi") < 60) & (F.col("_se") < 60) & named
    df = df.withColumn("_local", F.when(sound, F.col("_day") * _DAY_US + clock))
    df = _cut(df.select("_row", "_hint", "_s", "_zone", "_local"))
    hint = F.nullif(F.trim("_hint"), F.lit(""))
    df = df.withColumns({"_iana": F.coalesce(hint, F.lit(default_zone)), "_read": F.when(F.col("_zone").isNull(), F.col("_local"))})
    df = _cut(_with_local_to_utc(df, "_read", "_iana", "_by_zone", ambiguous, default_zone))
    df = df.withColumn("_digits", F.regexp_extract("_zone", r"[+-]([0-9:]+)$", 1))
    plain = F.replace("_digits", F.lit(":"), F.lit("")).try_cast("int")
    df = df.withColumn("_clock", F.when(F.length("_digits") <= 2, plain * 100).otherwise(plain))
    parsed = F.when(F.col("_zone").isNotNull(), F.col("_local") - _offset_minutes(F.col("_zone"), F.col("_clock")).cast("long") * 60_000_000).otherwise(F.col("_by_zone"))
    # A filter on the result would be pushed through all of this and repeat it many times over; the partition
    # number, being no deterministic expression, stops it here.
    micros = F.when(F.spark_partition_id() >= 0, F.coalesce(unix_micros_by_size(F.col("_s")), parsed))
    return df.withColumn(out, micros).select(*[F.col("_row").getField(c).alias(c) for c in columns], out)


@functools.cache
def _known_zones() -> dict[str, str]:
    """Names of the time zone database by their lower-case form; a hint of another name is no zone."""
    # Placeholders of the database itself are no zones; the JVM knows one alias under its other name only.
    none = {"Factory", "localtime", "posixrules", "leapseconds", "ROC"}
    return {z.lower(): z for z in sorted(zoneinfo.available_timezones() - none)} | {"roc": "Asia/Taipei"}


def zone_name(c: Column) -> Column:
    """The time zone database's spelling of a name in any case; null if it names no zone."""
    known = _known_zones()
    every = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.when(c.isin(list(known.values())), c).when(F.lower(c).isin(list(known)), F.try_element_at(every, F.lower(c)))


def _with_local_to_utc(df: DataFrame, local: str, zone: str, out: str, ambiguous: str, usual: str) -> DataFrame:
    """A local clock reading (as microseconds) in an IANA zone as UTC microseconds.

    The offsets in force a day before and a day after give the two candidate
    instants; a candidate counts if it shows the reading on its clock.  None:
    the reading never occurs.  Two different ones: it occurs twice.  The zone
    ``usual`` is looked up once, others row by row.
    """
    df = df.withColumn("_z", zone_name(F.col(zone)))

    def shown(micros: Column) -> Column:
        ts = F.timestamp_micros(micros)
        return F.unix_micros(F.when(F.col("_z") == usual, F.from_utc_timestamp(ts, F.lit(usual))).otherwise(F.from_utc_timestamp(ts, F.col("_z"))))

    here = F.col(local)
    df = df.withColumns({"_a": here - (shown(here - _DAY_US) - (here - _DAY_US)), "_b": here - (shown(here + _DAY_US) - (here + _DAY_US))})
    df = df.withColumn("_sa", shown(F.col("_a")) == here)
    df = df.withColumn("_sb", F.when(F.col("_a") == F.col("_b"), F.col("_sa")).otherwise(shown(F.col("_b")) == here))
    pick = {"refuse": F.lit(None).cast("long"), "first": F.least("_a", "_b"), "second": F.greatest("_a", "_b")}[ambiguous]
    return df.withColumn(out, F.when(F.col("_sa") & F.col("_sb") & (F.col("_a") != F.col("_b")), pick).when(F.col("_sa"), F.col("_a")).when(F.col("_sb"), F.col("_b")))
