"""Queries of the general data problems (p1 to p7) over their whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import instants, keys, listing
from tracewell.operators import nested, pit_join, redelivery, references, snapshots, units
from tracewell.sources.tables import table


def _removed(spark: SparkSession, d: str, name: str, key: Column) -> DataFrame:
    rows = table(spark, d, "removed_rows").where(F.col("table_name") == name)
    return rows.select(key.alias("key"), F.col("created_at").alias("valid_from"), F.col("removed_at").alias("valid_to"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    never = F.lit(None).cast("timestamp")
    filing = keys.uuid_key("row_key").try_cast("long")
    filings = references.parent_keys(
        table(spark, d, "filings").select(F.col("cse_filing_id").alias("key"), F.col("first_seen_at").alias("valid_from"), never.alias("valid_to")),
        _removed(spark, d, "filings", filing),
    )
    issuers = references.parent_keys(table(spark, d, "issuers").select(keys.uuid_key("issuer_id").alias("key"), F.col("created_at").alias("valid_from"), F.col("retired_at").alias("valid_to")))
    kinds = references.parent_keys(
        table(spark, d, "classifications").select(keys.uuid_key("id").alias("key"), F.col("classified_at").alias("valid_from"), never.alias("valid_to")),
        _removed(spark, d, "classifications", keys.uuid_key("row_key")),
    )
    children = (
        ("classifications", F.col("id"), F.col("cse_filing_id"), "classified_at", filings),
        ("issuer_decisions", F.col("id").cast("string"), keys.uuid_key("issuer_id"), "decided_at", issuers),
        ("extraction_runs", F.col("f5_run_id"), keys.uuid_key("classification_id"), "recorded_at", kinds),
    )
    out = None
    for name, row_key, fk, t, parents in children:
        child = table(spark, d, name).select(row_key.alias("row_key"), fk.alias("fk"), F.col(t).alias("t"))
        part = references.orphan_references(child, parents).select(F.lit(name).alias("table_name"), "row_key", "t", "kind")
        out = part if out is None else out.unionByName(part)
    return out


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "row_key", keys.month_utc("t").alias("month_utc"), "kind")


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_counts(_orphans(spark, d))


COMPANY_BODY = nested.Layout(("body", "bodies"), ("reqSymbolInfo", "reqSymbolBetaInfo", "reqLogo"), ("tradeWindows", "history", "versions"))
COMPANY_KEYS = {"reqSymbolInfo": "symbol", "reqSymbolBetaInfo": "securityId", "reqLogo": "secId"}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    bridge, objects = nested.flatten_objects(table(spark, d, "company_info_raw"), "raw_id", "body", COMPANY_BODY)
    found = nested.owner_keys(nested.block_rows(bridge, COMPANY_BODY), objects, COMPANY_KEYS)
    return found.select(F.col("record_id").alias("raw_id"), F.col("root_no").alias("company_no"), "block_name", "item_path", "key_value")


def p2_places(spark: SparkSession, d: str) -> DataFrame:
    """Where every object of the company bodies stands, its parent by its path."""
    bridge, _ = nested.flatten_objects(table(spark, d, "company_info_raw"), "raw_id", "body", COMPANY_BODY)
    return bridge.select(F.col("record_id").alias("raw_id"), F.col("root_no").alias("company_no"), "path", "depth", "field_name")


def p2_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Every occurrence of an object in the company bodies, down from the company object."""
    bridge, _ = nested.flatten_objects(table(spark, d, "company_info_raw"), "raw_id", "body", COMPANY_BODY)
    return bridge.withColumnsRenamed({"record_id": "raw_id", "root_no": "company_no"}).withColumns({c: F.lower(F.hex(c)) for c in ("object_hash", "parent_hash")})


def p2_objects(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct object of the company bodies once."""
    _, objects = nested.flatten_objects(table(spark, d, "company_info_raw"), "raw_id", "body", COMPANY_BODY)
    return objects.withColumn("object_hash", F.lower(F.hex("object_hash")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "listing_snapshots")
    found = snapshots.snapshot_changes(rows, "snapshot_no", "cse_filing_id", listing.raw_content("raw_item"))
    return found.select("snapshot_no", F.col("key").alias("cse_filing_id"), "change_kind")


def p3_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "listing_snapshots")
    found = snapshots.snapshot_changes(rows, "snapshot_no", "cse_filing_id", listing.raw_content("raw_item"))
    return snapshots.change_values(found, rows, "snapshot_no", "cse_filing_id", listing.raw_content("raw_item")).withColumnRenamed("key", "cse_filing_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return units.known_amounts(table(spark, d, "reported_values"), "value_id")


def p4_source_scales(spark: SparkSession, d: str) -> DataFrame:
    """Scale of each heading text, as the source graph estimates it from amounts that two sources state.

    Such an amount is a cell under a heading whose reported scale counts: the
    heading states it as printed, the reported scale in single units.  No word
    of the heading is read.  A unit in the raw text or label is the cell's own
    and overrides the other two, so no second source states that amount;
    amounts that share issuer and concept only are different ones.
    """
    rows = units.declared_amounts(table(spark, d, "reported_values").where("value_type = 'currency_amount' and scale_evidence is not null"))
    number, single = F.col("declared.number").cast("double"), "reported_scale:10000"
    scaled = F.struct(F.lit(single).alias("source"), (number * F.col("reported_scale")).alias("number"))
    headed = F.struct(F.concat(F.lit("heading:"), "scale_evidence").alias("source"), number.alias("number"))
    stated = rows.where("declared.unit_basis = 'reported_scale'").select("value_id", F.explode(F.array(scaled, headed)).alias("s"))
    anchors = spark.createDataFrame([(single, 0.0)], "source string, log10_scale double")
    return units.source_scales(stated, F.col("value_id"), F.col("s.source"), F.col("s.number"), anchors)


def observation_identity() -> list[Column]:
    """What names one delivered listing message; a stored hash, where present, is the content's own."""
    stored = keys.bare("metadata_hash")
    content = F.coalesce(F.when(stored.rlike("^[0-9a-f]{64}$"), stored), F.sha2(listing.raw_content("raw_item"), 256))
    return [F.col("cse_filing_id"), listing.endpoint_name("source_endpoint"), listing.bucket_name("source_bucket"), content]


def surplus_observations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "filing_observations").where(F.col("cse_filing_id").isNotNull())
    return redelivery.superfluous(rows, observation_identity(), "delivery_no", [F.col("observed_at")], F.col("observed_at"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    filings = redelivery.superfluous(table(spark, d, "filings"), [F.col("cse_filing_id")], "delivery_no", [], F.col("first_seen_at"))
    a = surplus_observations(spark, d).select(F.lit("filing_observations").alias("table_name"), "delivery_no")
    return a.unionByName(filings.select(F.lit("filings").alias("table_name"), "delivery_no"))


COLOMBO_EPOCH_US = -19_800_000_000


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "feed_items")
    fields = ("uploaded_date", "manual_date", "authorized_date")
    texts = feed.select("feed_row_no", F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in fields])).alias("f"))
    texts = texts.select(F.lit("feed_items").alias("table_name"), F.col("feed_row_no").alias("row_no"), "f.field_name", "f.text", F.lit(None).cast("string").alias("zone_hint"))
    raw = table(spark, d, "source_instants").select(F.lit("source_instants").alias("table_name"), F.col("instant_id").alias("row_no"), F.lit("raw").alias("field_name"), F.col("raw").alias("text"), "zone_hint")
    out = instants.with_utc_micros(texts.unionByName(raw), "text", "zone_hint", "utc_us")
    # The empty manual date is written as the Colombo midnight of 1 January 1970, mostly in milliseconds.
    blank = (F.col("field_name") == "manual_date") & ((F.col("utc_us") == COLOMBO_EPOCH_US) | F.trim("text").rlike(r"^-19800(?:000){0,2}(?:\.0+)?$"))
    return keys.kept_once(out, F.col("utc_us").isNotNull() & ~blank).select("table_name", "row_no", "field_name", "utc_us")


def _as_known(spark: SparkSession, d: str, only_changed: bool) -> DataFrame:
    runs = table(spark, d, "extraction_runs").select(F.lit("extraction_runs").alias("table_name"), F.col("f5_run_id").alias("row_key"), "cse_filing_id", F.col("recorded_at").alias("t"))
    views = table(spark, d, "knowledge_views").select(F.lit("knowledge_views").alias("table_name"), F.col("view_id").cast("string").alias("row_key"), "cse_filing_id", F.col("known_at").alias("t"))
    decisions = table(spark, d, "issuer_decisions").select("cse_filing_id", "decided_at", F.col("id").alias("decision_id"))
    listed = table(spark, d, "filing_observations").select("cse_filing_id", "observed_at", "delivery_no")
    listed = listed.join(surplus_observations(spark, d), "delivery_no", "left_anti")
    changes = [pit_join.Changes(decisions, "decided_at", ("decision_id",), "highest"), pit_join.Changes(listed, "observed_at", ("delivery_no",))]
    known = pit_join.known_states(runs.unionByName(views), "cse_filing_id", "t", changes, "final_")
    if only_changed:
        known = known.where(~F.col("decision_id").eqNullSafe(F.col("final_decision_id")) | ~F.col("delivery_no").eqNullSafe(F.col("final_delivery_no")))
    none = F.lit(-1).cast("long")
    # Exact copies of a run count once; they have equal answers, so they are dropped where fewest columns and rows are left.
    once = known.select("table_name", "row_key", "cse_filing_id", "t", F.coalesce("decision_id", none).alias("decision_id"), F.coalesce("delivery_no", none).alias("delivery_no")).distinct()
    return once.drop("cse_filing_id", "t")


def p7_known(spark: SparkSession, d: str) -> DataFrame:
    return _as_known(spark, d, False)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _as_known(spark, d, True)


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_places, p2_bridge, p2_objects, p3_found, p3_values, p4_found, p4_source_scales, p5_found, p6_found, p7_found, p7_known)}
