"""Every query with SQL equals it on the smallest tables; the others run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tracewell.sources.shared import scratch

DATA = "/root/testdata/sf0.001"
SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("p8_", "p9_", "p10_"))}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def _db():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tmp_path, name):
    c = _db()
    with scratch():
        entry.queries()[name](spark, DATA).write.parquet(f"{tmp_path}/out")
    c.execute(f"create table want as select * from ({SQL[name]})")
    c.execute(f"create table got as select * from read_parquet('{tmp_path}/out/*.parquet')")
    cols = sorted(r[0] for r in c.execute("describe want").fetchall())
    assert cols == sorted(r[0] for r in c.execute("describe got").fetchall())
    listed = ", ".join(f'"{x}"' for x in cols)
    for a, b in (("want", "got"), ("got", "want")):
        assert c.execute(f"select {listed} from {a} except all select {listed} from {b} limit 3").fetchall() == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
