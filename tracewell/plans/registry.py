"""All queries outside the text subpackage, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewell.plans import problems, problems_sql, reference, reference_more, reference_records, reference_rest, reference_sets, reference_text
from tracewell.streaming import queries as streams

# The reference's queries register themselves where they are defined.
_MODULES = (reference, reference_more, reference_records, reference_rest, reference_sets, reference_text)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {**problems.QUERIES, **reference.QUERIES, **streams.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**problems_sql.SQL, **reference.SQL, **streams.SQL}
