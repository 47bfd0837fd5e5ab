"""The point-in-time API: refusals, modes, padding, explanations, and no leakage."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tracewell import asof
from tracewell.asof import AsOf, Evidence, QueryRefused

UTC = dt.UTC


def day(n):
    return dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(days=n)


@pytest.mark.parametrize(
    ("args", "code"),
    [(("x",), "unknown_mode"), (("known",), "cutoff_required"), (("known", day(1), day(2)), "horizon_not_allowed"), (("current", day(1), day(2)), "cutoff_not_allowed"), (("available", day(1)), "horizon_required"),
     (("available", day(2), day(1)), "horizon_before_cutoff"), (("known", dt.datetime(2024, 1, 1)), "naive_timestamp")],
)
def test_refusals(args, code):
    with pytest.raises(QueryRefused) as e:
        AsOf(*args)
    assert e.value.code == code


COLS = "fact int, document int, v decimal(10,2), h decimal(10,2), available timestamp, known timestamp"


def world(spark, data):
    return Evidence(spark.createDataFrame(data, COLS), "fact", "document", "v", "h", "available", "known")


def item(f, doc, v, a, k):
    naive = lambda n: None if n is None else day(n).replace(tzinfo=None)
    return f, doc, Decimal(v), Decimal(1), naive(a), naive(k)


def test_modes_padding_and_reasons(spark):
    e = world(spark, [item(1, 1, 10, 0, 0), item(1, 2, 11, 5, 6), item(1, 3, 50, 9, 9), item(2, 1, 5, None, 1), item(3, 1, 7, 2, None)])
    state = lambda q: {r["fact"]: r["state"] for r in e.answer(q).collect()}
    assert state(AsOf("known", day(1))) == {1: "single_source", 2: "single_source"}
    assert state(AsOf("available", day(5), day(6))) == {1: "corroborated"}
    assert state(AsOf("current", None, day(20))) == {1: "conflicting", 2: "single_source"}
    assert state(AsOf("known", day(6), facts=(1, 3, 99))) == {1: "corroborated", 3: "none", 99: "none"}
    reasons = sorted((r["fact"], r["document"], r["reason"]) for r in e.explain(AsOf("available", day(5), day(6))).collect())
    assert reasons == [(1, 3, "known_after_horizon"), (1, 3, "not_available_by_cutoff"), (2, 1, "availability_unknown"), (3, 1, "knowledge_chain_incomplete")]
    assert e.timeline("known", [day(1), day(6)], (1,)).count() == 2
    assert {r["label"] for r in e.answer(AsOf("current", None, day(3))).collect()} == {"retrospective_current"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_answers_do_not_change_when_the_future_is_taken_away(spark, seed):
    rnd = random.Random(seed)
    data = [item(rnd.randrange(12), rnd.randrange(4), rnd.randrange(10, 14), rnd.choice([None, rnd.randrange(60)]), rnd.choice([None, rnd.randrange(60)])) for _ in range(150)]
    for t in (10, 35):
        q = AsOf("known", day(t))
        past = [d for d in data if d[5] is not None and d[5] <= day(t).replace(tzinfo=None)]
        assert sorted(map(str, world(spark, data).answer(q).collect())) == sorted(map(str, world(spark, past).answer(q).collect()))


def test_seal_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else f"v{i}") for i in range(50)], "i int, v string")
    one = asof.seal(df).first()
    assert one["n_rows"] == 50 and asof.seal(df.repartition(7).orderBy(F.desc("i"))).first() == one
    assert asof.seal(df.where("i <> 9")).first()["result_hash"] != one["result_hash"]


def test_configurations_in_force(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n, tzinfo=dt.UTC)
    store = asof.Configurations(spark, f"file://{tmp_path}/c")
    assert store.in_force(day(9)) is None
    a, b = store.register({"rule": 1, "x": [1]}, day(1)), store.register({"rule": 2}, day(1))
    assert store.register({"x": [1], "rule": 1}, day(5)) == a != b
    assert [store.designate(a, day(2)), store.designate(b, day(4)), store.designate(a, day(4))] == [1, 2, 3]
    assert store.in_force(day(1)) is None and store.in_force(day(3)) == {"rule": 1, "x": [1]} and store.in_force(day(4)) == {"rule": 1, "x": [1]}
    with pytest.raises(asof.QueryRefused, match="unknown_configuration"):
        store.designate("none", day(5))
    with pytest.raises(asof.QueryRefused, match="naive_timestamp"):
        store.register({}, dt.datetime(2024, 1, 1))
