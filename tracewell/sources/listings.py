"""Readers of raw listing payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM_SCHEMA = "id long, path string, path2 string, manualDate long, uploadedDate string, fileText string, name string, symbol string, logoUrl string, authorizedDate string"


def parse_items(rows: DataFrame, raw: str) -> DataFrame:
    """Listing entries as typed columns next to ``rows``; what does not parse is null."""
    item = F.from_json(raw, ITEM_SCHEMA)
    names = {"item_id": "id", "path": "path", "path2": "path2", "manual_date": "manualDate", "uploaded": "uploadedDate", "file_text": "fileText", "name": "name", "symbol": "symbol", "authorized": "authorizedDate"}
    return rows.withColumn("_i", item).withColumns({n: F.col(f"_i.{f}") for n, f in names.items()}).drop("_i")


def first_present(rows: DataFrame, item: str, names: Sequence[str], out: str) -> DataFrame:
    """The value of the first of ``names`` that is a key of the map ``item``, even a null one.

    Adds ``found_as`` (which name that was), ``several`` (more than one of them
    is a key) and ``disagree`` (and their values differ, null from others too).
    """
    value: Column = F.lit(None).cast("string")
    found: Column = F.lit(None).cast("string")
    for n in reversed(names):
        has = F.map_contains_key(item, F.lit(n))
        value, found = F.when(has, F.element_at(item, F.lit(n))).otherwise(value), F.when(has, F.lit(n)).otherwise(found)
    held = F.filter(F.map_entries(item), lambda e: e["key"].isin(list(names)))
    values = F.array_distinct(F.transform(held, lambda e: F.struct(e["value"].alias("v"))))
    return rows.withColumns({out: value, "found_as": found, "several": F.coalesce(F.size(held) > 1, F.lit(False)), "disagree": F.coalesce(F.size(values) > 1, F.lit(False))})


def _members(body: str) -> Column:
    """(key, value) of a body object's members in the order of the document; null if the body is no object."""
    v = F.try_variant_get(F.try_parse_json(body), "$", "map<string,variant>")
    # A variant keeps its keys sorted, a parsed map as written.
    written = F.map_keys(F.from_json(body, "map<string,string>"))
    return F.transform(F.when(v.isNotNull(), written), lambda k: F.struct(k.alias("key"), F.element_at(v, k).alias("value")))


def row_list(rows: DataFrame, body: str) -> DataFrame:
    """(columns of rows, pos, element): entries of a body that is a list, or of the first list, in document order, among a body object's values."""
    v = F.try_parse_json(body)
    as_list = lambda x: F.try_variant_get(x, "$", "array<variant>")
    first = F.get(F.filter(F.transform(_members(body), lambda m: as_list(m["value"])), lambda x: x.isNotNull()), F.lit(0))
    return rows.select("*", F.posexplode(F.coalesce(as_list(v), first, F.array().cast("array<variant>"))).alias("pos", "element"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of one JSON object per line under a declared schema; broken lines are dropped by nobody: they are all-null rows."""
    return spark.read.schema(schema).json(path)


def best_block(rows: DataFrame, body: str, candidates: Sequence[str]) -> DataFrame:
    """The nested block of a body object that holds most of the candidate names.

    Adds ``block`` (its key), ``score`` and ``ambiguous`` (another block holds
    as many).  Ties go to the first block in document order; no candidate
    anywhere, or a body that is no object of blocks, gives null and 0.
    """
    names = F.array(*[F.lit(c) for c in candidates])
    inner = lambda v: F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    scored = F.transform(_members(body), lambda m, i: F.struct((-F.size(F.array_intersect(inner(m["value"]), names))).alias("m"), i.alias("i"), m["key"].alias("k"), inner(m["value"]).isNotNull().alias("o")))
    rows = rows.withColumn("_b", F.array_sort(F.filter(scored, lambda s: s["o"]))).withColumn("_t", F.get("_b", F.lit(0)))
    hit = F.coalesce(F.col("_t.m") < 0, F.lit(False))
    return rows.withColumns({"block": F.when(hit, F.col("_t.k")), "score": F.when(hit, -F.col("_t.m")).otherwise(F.lit(0)), "ambiguous": hit & F.coalesce(F.get("_b", F.lit(1))["m"] == F.col("_t.m"), F.lit(False))}).drop("_b", "_t")


# List keys of a listing body that hold no filings.
NO_FILINGS = ("reqFinancial", "infoCompanyBannerAd")
# The list keys that do, and their buckets.
BUCKETS = {"infoAnnualData": "annual", "infoQuarterlyData": "quarterly", "infoOtherData": "other", "infoWebLink": "web_link"}


def listing_buckets(rows: DataFrame, body: str) -> tuple[DataFrame, DataFrame]:
    """(entries, bodies) of listing bodies.

    entries: (columns of rows, bucket, pos, item), one per entry of a bucket.
    bodies: (columns of rows, failure, unrecognised), failure being
    ``non_json``, ``unexpected_schema`` (no object, no bucket, or a bucket that
    is no list; such a body has no entries) or null, unrecognised the sorted
    other list keys.  A null bucket is an empty one.
    """
    v = F.try_parse_json(body)
    members = F.try_variant_get(v, "$", "map<string,variant>")
    as_list = lambda x: F.try_variant_get(x, "$", "array<variant>")
    known = F.filter(F.map_keys(members), lambda k: k.isin(list(BUCKETS)))
    broken = F.exists(known, lambda k: ~F.is_variant_null(F.element_at(members, k)) & as_list(F.element_at(members, k)).isNull())
    failure = F.when(v.isNull(), "non_json").when(members.isNull() | (F.size(known) == 0) | broken, "unexpected_schema")
    other = F.array_sort(F.filter(F.map_keys(members), lambda k: ~k.isin([*BUCKETS, *NO_FILINGS]) & as_list(F.element_at(members, k)).isNotNull()))
    read = rows.withColumns({"failure": failure, "unrecognised": F.when(failure.isNull(), other).otherwise(F.array().cast("array<string>"))})
    lists = F.array(*[F.struct(F.lit(b).alias("bucket"), as_list(F.try_element_at(members, F.lit(k))).alias("items")) for k, b in BUCKETS.items()])
    entries = read.where(F.col("failure").isNull()).select(*rows.columns, F.inline(lists)).select(*rows.columns, "bucket", F.posexplode("items").alias("pos", "item"))
    return entries, read
