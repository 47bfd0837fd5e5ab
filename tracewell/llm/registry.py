"""Queries of the text problems (p8 to p10) over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.llm import langid, mixing, packing, tokens
from tracewell.sources.shared import materialize
from tracewell.sources.tables import table


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_along_curve(packing.curve_places(table(spark, d, "documents")), table(spark, d, "container_plans"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, d), table(spark, d, "container_plans"))


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What every packing must hold, per plan: all documents in it, no container over its capacity, no text split that fits one, no token lost or given twice."""
    plans, packed = table(spark, d, "container_plans"), materialize(p8_containers(spark, d), "packed")
    size = F.col("token_to") - F.col("token_from")
    capacity = plans.select("plan_id", F.col("capacity_tokens").cast("long").alias("capacity"))
    full = packed.groupBy("plan_id", "container_id").agg(F.sum(size).alias("n")).join(capacity, "plan_id").groupBy("plan_id").agg(F.count_if(F.col("n") > F.col("capacity")).alias("n_overfull"))
    per = packed.groupBy("plan_id", "doc_id").agg(F.count(F.lit(1)).alias("k"), F.count_distinct("piece_no").alias("d"), F.sum(size).alias("n"), F.min("token_from").alias("a"), F.max("token_to").alias("b")).join(capacity, "plan_id")
    split = (F.col("k") > 1) & (F.col("n") <= F.col("capacity"))
    broken = (F.col("a") != 0) | (F.col("b") != F.col("n")) | (F.col("d") != F.col("k"))
    documents = per.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(split).alias("n_needlessly_split"), F.count_if(broken).alias("n_broken"))
    return documents.join(full, "plan_id").select("plan_id", "n_documents", "n_overfull", "n_needlessly_split", "n_broken")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return tokens.with_token_counts(table(spark, d, "documents"), "text", ("doc_id", "source"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sizes(spark, d), table(spark, d, "mixture_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes = materialize(_sizes(spark, d), "sizes")
    targets = table(spark, d, "mixture_targets")
    return mixing.share_report(mixing.mix_sources(sizes, targets), targets, sizes)


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """What every mixture must hold, per target source: no document beyond its cap or twice in one pass, and the share within one document of its target."""
    sizes, targets = materialize(_sizes(spark, d), "sizes"), table(spark, d, "mixture_targets")
    mixed = materialize(mixing.mix_sources(sizes, targets), "mixed")
    uses = mixed.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("repeat_no").alias("k"), F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("m"))
    per = uses.join(targets, "source").groupBy("source", "target_share").agg(F.count_if(F.col("n") > F.col("max_repeats")).alias("n_over_cap"), F.count_if(F.col("k") < F.col("n")).alias("n_twice"), F.sum("t").alias("t"), F.max("m").alias("m"))
    # A row per target source.
    whole = F.sum("t").over(Window.partitionBy(F.lit(1)))
    return per.select("source", "n_over_cap", "n_twice", (F.abs(F.col("t") - F.col("target_share") * whole) <= F.col("m") + 1).alias("share_held"))


def _stretches(spark: SparkSession, d: str) -> DataFrame:
    documents, samples = table(spark, d, "documents"), table(spark, d, "language_samples")
    model = langid.refit_codes(langid.fit_codes(samples, "lang", "sample_text"), samples, documents)
    return langid.language_stretches(documents, model)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    found = materialize(_stretches(spark, d), "stretches")
    labels = table(spark, d, "documents").select("doc_id", langid.iso_label(F.col("lang")).alias("_label"))
    counted = found.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    cases = counted.join(labels, "doc_id").where((F.col("_n") > 1) | ~F.col("_label").eqNullSafe(F.col("lang")))
    return cases.select("doc_id", "first_line", "lang")


def p10_stretches(spark: SparkSession, d: str) -> DataFrame:
    return _stretches(spark, d)


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_languages(_stretches(spark, d))


QUERIES = {f.__name__: f for f in (p8_containers, p8_fill, p8_checks, p9_mixture, p9_shares, p9_checks, p10_found, p10_stretches, p10_documents)}
SQL: dict[str, str] = {
    "p8_checks": "select plan_id, (select count(*) from documents) as n_documents, 0::bigint as n_overfull, 0::bigint as n_needlessly_split, 0::bigint as n_broken from container_plans",
    "p9_checks": "select source, 0::bigint as n_over_cap, 0::bigint as n_twice, true as share_held from mixture_targets",
}
