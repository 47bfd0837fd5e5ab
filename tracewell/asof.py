"""The point-in-time question as an API: what a set of evidence says, as of when, known by when."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import evidence, ordered

# Modes, the label of their answers, and whether they take T and H.
MODES = {"recorded": ("known_recorded", True, False), "known": ("known", True, False), "available": ("reconstructed", True, True), "current": ("retrospective_current", False, True)}


class QueryRefused(ValueError):
    """A question that has no defined answer; ``code`` names why."""

    def __init__(self, code: str) -> None:
        super().__init__(code)
        self.code = code


@dataclass(frozen=True)
class AsOf:
    """A validated question.  T: what was published or recorded by then; H: what is known by then.

    Instants carry a zone.  ``recorded`` and ``known`` take T only, ``current``
    H only, ``available`` both with H not before T.
    """

    mode: str
    at: dt.datetime | None = None
    horizon: dt.datetime | None = None
    facts: tuple = ()

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise QueryRefused("unknown_mode")
        _, takes_at, takes_horizon = MODES[self.mode]
        for value, takes, name in ((self.at, takes_at, "cutoff"), (self.horizon, takes_horizon, "horizon")):
            if takes and value is None:
                raise QueryRefused(f"{name}_required")
            if not takes and value is not None:
                raise QueryRefused(f"{name}_not_allowed")
            if value is not None and value.tzinfo is None:
                raise QueryRefused("naive_timestamp")
        if self.at and self.horizon and self.horizon < self.at:
            raise QueryRefused("horizon_before_cutoff")

    @property
    def label(self) -> str:
        return MODES[self.mode][0]


@dataclass(frozen=True)
class Evidence:
    """Printed values of facts in documents, with when each was published and recorded."""

    rows: DataFrame
    fact: str
    document: str
    value: str
    half_unit: str
    available_at: str
    known_at: str
    order: Sequence[str] = ()

    def _cutoffs(self, q: AsOf):
        lit = lambda v: None if v is None else F.timestamp_micros(F.lit(int((v - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) / dt.timedelta(microseconds=1))))
        return lit(q.at), lit(q.horizon)

    def visible(self, q: AsOf) -> DataFrame:
        """The rows the question may use; a fact filter reaches the scan."""
        rows = self.rows.where(F.col(self.fact).isin(list(q.facts))) if q.facts else self.rows
        return evidence.visible_evidence(rows, q.mode, self.available_at, self.known_at, *self._cutoffs(q))

    def answer(self, q: AsOf) -> DataFrame:
        """One row per fact with its state and the answer's label; facts asked for that nothing shows have state ``none``."""
        out = evidence.reconcile_facts(self.visible(q), self.fact, self.document, self.value, self.half_unit, [self.document, *self.order])
        if q.facts:
            asked = self.rows.sparkSession.createDataFrame([(f,) for f in dict.fromkeys(q.facts)], [self.fact]).select(F.col(self.fact).cast(self.rows.schema[self.fact].dataType))
            out = asked.join(out, self.fact, "left").withColumn("state", F.coalesce("state", F.lit("none")))
        return out.withColumn("label", F.lit(q.label))

    def timeline(self, mode: str, cutoffs: Sequence[dt.datetime], facts: tuple = ()) -> DataFrame:
        """The answers at several cutoffs, one question each, with the cutoff."""
        if not cutoffs:
            raise QueryRefused("cutoff_required")
        out = None
        for c in sorted(set(cutoffs)):
            q = AsOf(mode, horizon=c, facts=facts) if mode == "current" else AsOf(mode, c, c if mode == "available" else None, facts)
            part = self.answer(q).withColumn("cutoff", F.lit(c.astimezone(dt.UTC).isoformat()))
            out = part if out is None else out.unionByName(part)
        return out

    def explain(self, q: AsOf) -> DataFrame:
        """Why rows are not used: (columns of the rows, reason), one row per reason."""
        at, horizon = self._cutoffs(q)
        a, k = F.col(self.available_at), F.col(self.known_at)
        limit = horizon if horizon is not None else at
        reasons = [F.when(k.isNull(), "knowledge_chain_incomplete").when(k > limit, "known_after_horizon")]
        if q.mode == "available":
            reasons.append(F.when(a.isNull(), "availability_unknown"))
        if q.mode in ("known", "available"):
            reasons.append(F.when(a > at, "not_available_by_cutoff"))
        rows = self.rows.where(F.col(self.fact).isin(list(q.facts))) if q.facts else self.rows
        return rows.select("*", F.explode(F.array_compact(F.array(*reasons))).alias("reason"))

    def availability(self, facts: tuple = ()) -> DataFrame:
        """(document, available_at, known_at, n_facts): when each document was first public and first known, null if never stated."""
        rows = self.rows.where(F.col(self.fact).isin(list(facts))) if facts else self.rows
        return rows.groupBy(self.document).agg(F.min(self.available_at).alias("available_at"), F.min(self.known_at).alias("known_at"), F.count_distinct(self.fact).alias("n_facts"))


def seal(answer: DataFrame) -> DataFrame:
    """(n_rows, result_hash) of an answer: equal exactly for equal rows, in whatever order and partitions they come."""
    limbs = ordered.table_digest(answer)
    return limbs.select("n_rows", F.sha2(F.concat_ws(".", *[F.col(c).cast("string") for c in limbs.columns]), 256).alias("result_hash"))


class Configurations:
    """Append-only register of configurations by content hash, and of which one is designated from when on.

    ``path`` is a folder of Parquet files.  Nothing is changed in place: what
    was in force at an instant stays answerable.
    """

    _KINDS = {"configurations": "key string, body string, recorded_at timestamp", "designations": "number long, key string, recorded_at timestamp"}

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _append(self, name: str, row: tuple) -> None:
        self.spark.createDataFrame([row], self._KINDS[name]).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def _rows(self, name: str) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], self._KINDS[name])
        return self.spark.read.schema(self._KINDS[name]).parquet(f"{self.path}/{name}")

    def register(self, body: Mapping, recorded_at: dt.datetime) -> str:
        """The key of a configuration; one that is held already is not written again."""
        if recorded_at.tzinfo is None:
            raise QueryRefused("naive_timestamp")
        text = json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=True)
        key = hashlib.sha256(text.encode()).hexdigest()
        if self._rows("configurations").where(F.col("key") == key).isEmpty():
            self._append("configurations", (key, text, recorded_at))
        return key

    def designate(self, key: str, recorded_at: dt.datetime) -> int:
        """The number of a designation, one more than the last."""
        if recorded_at.tzinfo is None:
            raise QueryRefused("naive_timestamp")
        if self._rows("configurations").where(F.col("key") == key).isEmpty():
            raise QueryRefused("unknown_configuration")
        number = (self._rows("designations").agg(F.max("number")).first()[0] or 0) + 1
        self._append("designations", (number, key, recorded_at))
        return number

    def in_force(self, at: dt.datetime) -> dict | None:
        """The configuration of the last designation recorded by an instant; None before the first."""
        rows = self._rows("designations").where(F.col("recorded_at") <= F.lit(at)).agg(F.max_by("key", "number").alias("key"))
        held = rows.join(self._rows("configurations").select("key", "body"), "key").select("body").first()
        return None if held is None else json.loads(held[0])
