"""Intermediate tables in the folder that every executor shares.

The folder is the session's ``spark.checkpoint.dir``.  Where that is unset, a
session whose master is local gets a temporary folder; any other is refused,
since its executors would write to disks of their own.  Written tables cut the
lineage: a lost executor re-reads files instead of recomputing Python stages,
and a range partitioner samples the files instead of running the upstream plan
twice.  They are removed when the :func:`scratch` block around a query ends,
else when the process does.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that every executor reaches")
        given = "file://" + tempfile.mkdtemp(prefix="tracewell-")
        spark.conf.set("spark.checkpoint.dir", given)
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet, removed as intermediate tables are."""
    path = f"{shared_dir(spark)}/tracewell/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_cleanup)
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(_schema_after(df, partition_by)).parquet(path)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Intermediate tables written inside the block are removed at its end: build the query and use its result inside."""
    before = len(_written)
    try:
        yield
    finally:
        _cleanup(before)


def _schema_after(df: DataFrame, partition_by: tuple[str, ...]):
    from pyspark.sql.types import StructType

    fields = list(df.schema.fields)
    return StructType([f for f in fields if f.name not in partition_by] + [f for f in fields if f.name in partition_by])


def _cleanup(first: int = 0) -> None:
    """Remove what this process wrote; a session that is already gone owns its folder."""
    for spark, path in _written[first:]:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - shutting down
            continue
    del _written[first:]
