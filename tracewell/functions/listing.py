"""Content identity of one listing entry (the raw JSON of a filing)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.keys import as_col, bare

# The nine fields that make up an entry's content, in key order.
CONTENT_FIELDS = ("authorizedDate", "fileText", "id", "manualDate", "name", "path", "path2", "symbol", "uploadedDate")

# Listing keys of the source and the bucket names they mean.
BUCKET_NAMES = {"infoannualdata": "annual", "infoquarterlydata": "quarterly", "infootherdata": "other", "infoweblink": "web_link"}


def content_json(variant: Column) -> Column:
    """Canonical JSON of the content fields of a parsed entry.

    Keys sorted, no blanks, non-ASCII as is; an absent key is left out while a
    null value is written, so the two differ.  Key order, spacing, escapes and
    any other keys of the source text do not matter.  Null for a null variant.
    """
    parts = []
    for key in CONTENT_FIELDS:
        value = F.variant_get(variant, f"$.{key}", "variant")
        parts.append(F.when(value.isNotNull(), F.concat(F.lit(f'"{key}":'), F.coalesce(F.to_json(value), F.lit("null")))))
    return F.when(variant.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))


def raw_content(raw: str | Column) -> Column:
    """Canonical content of a raw entry; a text that is no JSON is its own content."""
    raw = as_col(raw)
    return F.coalesce(content_json(F.try_parse_json(raw)), raw)


def endpoint_name(c: str | Column) -> Column:
    """Endpoint without case, outer blanks and the ``/api/`` prefix; null when blank."""
    s = F.regexp_replace(bare(c), "^/api/", "")
    return F.when(F.length(s) > 0, s)


def bucket_name(c: str | Column) -> Column:
    """Bucket under its plain name; blank and null are ``none``."""
    s = F.regexp_replace(bare(c), "^/api/", "")
    named = s
    for raw, plain in BUCKET_NAMES.items():
        named = F.when(s == raw, F.lit(plain)).otherwise(named)
    return F.when(F.length(s) > 0, named).otherwise(F.lit("none"))


# Fixed value: how the feed writes a local time, which is +05:30.
FEED_TIME = "dd MMM yyyy hh:mm:ss a"


def instant_micros(text: str | Column) -> Column:
    """Microseconds since 1970 of a listing's time: whole numbers are milliseconds, else the feed's form; null if it is neither."""
    t = F.trim(as_col(text))
    local = F.try_to_timestamp(t, F.lit(FEED_TIME))
    return F.when(t.rlike("^-?[0-9]{1,15}$"), t.try_cast("long") * 1000).otherwise(F.unix_micros(F.to_utc_timestamp(local, "+05:30")))
