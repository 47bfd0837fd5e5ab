"""Streaming operators run to completion over the event table, each with the batch SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.sources.shared import fresh_path
from tracewell.streaming import capture


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return capture.read_events(spark, f"{d}/events.parquet*", schema)


def _run(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """Drain a stream into a table in the shared folder and read it."""
    home = fresh_path(spark, "stream")
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/log").outputMode("append").trigger(availableNow=True).start()
    else:
        q = stream.writeStream.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{home}/out")).option("checkpointLocation", f"{home}/log").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/out")


def r3_stream_dedup(spark, d):
    once = capture.once_per_key(_events(spark, d).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "3650 days")
    return _run(spark, once.select("user_id", "event_type"), "append")


def r4_changed_readings(spark, d):
    rows = _events(spark, d).select("user_id", "event_id", "event_type")
    return _run(spark, capture.changed_readings(rows, "user_id", "event_id", "event_type"), "append")


def r5_latest_state(spark, d):
    rows = _events(spark, d)
    return _run(spark, capture.latest_state(rows, "user_id", ["ts", "event_id"], "event_type"), "complete")


def r1_window_counts(spark, d):
    rows = _events(spark, d)
    per = rows.withColumn("day", F.to_date("ts")).groupBy("day", F.when(F.hour("ts") < 12, "post_open").otherwise("post_close").alias("capture_window")).agg(F.count(F.lit(1)).alias("n"))
    return _run(spark, per, "complete")


def r2_rederived_state(spark, d):
    """Latest event per user derived again from the log at every batch; the last derivation of a key counts."""
    home = fresh_path(spark, "stream")
    rows = _events(spark, d).select("user_id", "event_id", "ts", "event_type")
    latest = lambda log: log.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count(F.lit(1)).alias("n_events"))
    capture.rederive(rows, latest, f"{home}/log", f"{home}/out", "user_id", f"{home}/checkpoint").awaitTermination()
    out = spark.read.option("basePath", f"{home}/out").parquet(f"{home}/out")
    return out.groupBy("user_id").agg(F.max_by("event_type", "_batch").alias("event_type"), F.max_by("n_events", "_batch").alias("n_events"))


QUERIES = {f.__name__: f for f in (r1_window_counts, r2_rederived_state, r3_stream_dedup, r4_changed_readings, r5_latest_state)}
SQL = {
    "r1_window_counts": "select ts::date as day, case when hour(ts) < 12 then 'post_open' else 'post_close' end as capture_window, count(*) as n from events group by all",
    "r3_stream_dedup": "select distinct user_id, event_type from events",
    "r4_changed_readings": "select user_id, event_id, event_type, false as late from (select *, lag(event_type) over (partition by user_id order by event_id) as p from events) where p is not null and p <> event_type",
    "r2_rederived_state": "select user_id, arg_max(event_type, (ts, event_id)) as event_type, count(*) as n_events from events group by all",
    "r5_latest_state": "select user_id, arg_max(event_type, (ts, event_id)) as event_type, count(*) as n_events from events group by all",
}
