"""Streaming forms of capture: late data is kept, redeliveries are dropped, state follows events."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tracewell.session import ship


def read_events(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1) -> DataFrame:
    """A stream over a folder of Parquet files; zone-less timestamps become instants, as watermarks need."""
    ship(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    naive = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else stream


def once_per_key(stream: DataFrame, keys: list[str], event_time: str, within: str) -> DataFrame:
    """First delivery of each key; a repeat is recognised within the watermark, which only bounds the state."""
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(stream: DataFrame, event_time: str, width: str, late: str, by: str) -> DataFrame:
    """Counts per window and value; rows later than ``late`` no longer change a closed window."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def latest_state(stream: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Latest value by key in the order of its events, whatever order they arrive in (complete or update mode)."""
    return stream.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value), F.count(F.lit(1)).alias("n_events"))


def changed_readings(stream: DataFrame, key: str, sequence: str, value: str) -> DataFrame:
    """Readings that differ from the one before of the same key, carried over triggers as state.

    Rows of a trigger are taken in order of ``sequence``; a reading older than
    the last one seen is kept as late and changes no state.
    """
    kinds = dict(stream.dtypes)
    schema = f"`{key}` {kinds[key]}, `{sequence}` {kinds[sequence]}, `{value}` {kinds[value]}, late boolean"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # A key's rows of one trigger are put in order by one task; what a trigger reads bounds them.
        rows = pd.concat([f[[sequence, value]] for f in frames]).sort_values(sequence, kind="stable", ignore_index=True)
        seq, last = state.get if state.exists else (None, None)
        late = rows[sequence] < seq if seq is not None else pd.Series(False, index=rows.index)
        new = rows[~late]
        before = new[value].shift(1)
        if len(new):
            before.iloc[0] = last if seq is not None else new[value].iloc[0]
            state.update((new[sequence].iloc[-1].item() if hasattr(new[sequence].iloc[-1], "item") else new[sequence].iloc[-1], new[value].iloc[-1].item() if hasattr(new[value].iloc[-1], "item") else new[value].iloc[-1]))
        out = pd.concat([rows[late].assign(late=True), new[new[value] != before].assign(late=False)])
        out.insert(0, key, k[0])
        yield out

    return stream.groupBy(key).applyInPandasWithState(step, schema, f"seq {kinds[sequence]}, last {kinds[value]}", "append", GroupStateTimeout.NoTimeout)


# Parts of the log by hash of the key, and the column that holds their number.
LOG_PARTS = 256


def rederive(stream: DataFrame, derive: Callable[[DataFrame], DataFrame], append_to: str, derived: str, key: str, checkpoint: str, parts: int = LOG_PARTS):
    """Append every micro-batch to the log and derive the touched keys again from all that the log has of them.

    Late rows are therefore never dropped: they change the derived rows of
    their key.  The log lies in ``parts`` parts by hash of the key, and only
    the parts that a batch touches are read.  Batches are written under their
    number, so a replayed batch replaces its own files and nothing is counted
    twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        placed = rows.withColumns({"_batch": F.lit(number), "_part": F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")})
        placed.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{append_to}/_batch_no={number}")
        log = spark.read.option("basePath", append_to).parquet(append_to)
        here = log.where(F.col("_batch_no") == number)
        touched = here.select(key).distinct()
        # At most as many numbers as there are parts; as literals they select folders.
        numbers = [r["_part"] for r in here.select("_part").distinct().collect()]
        known = log.where(F.col("_part").isin(numbers)).drop("_batch", "_batch_no", "_part")
        derive(known.join(touched, key, "left_semi")).withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{derived}/_batch_no={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
