"""Small cases of the general data problems: nulls, ties, copies, empty tables, clashing names, brute force."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.functions import instants, listing, money
from tracewell.operators import nested, pit_join, redelivery, references, snapshots, units
from tracewell.plans import problems
from tracewell.plans.problems import COMPANY_BODY, COMPANY_KEYS

T0 = dt.datetime(2024, 1, 1)


def ts(day, us=0):
    return T0 + dt.timedelta(days=day, microseconds=us)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- 1 ----------------------------------------------------------------------------------------
CHILD, PARENT = "row_key string, fk string, t timestamp", "key string, valid_from timestamp, valid_to timestamp"


def test_orphans_by_kind(spark):
    child = spark.createDataFrame(
        [("a", "p", ts(5)), ("a", "p", ts(5)), ("b", "p", ts(1)), ("c", "p", ts(9)), ("d", "none", ts(5)), ("e", None, ts(5)), ("f", "none", None), ("g", "p", None), ("h", "q", ts(9)), ("i", "r", ts(3))], CHILD
    )
    present = spark.createDataFrame([("p", ts(2), None), ("q", ts(9), ts(9)), (None, ts(0), None)], PARENT)
    removed = spark.createDataFrame([("p", ts(2), ts(8)), ("r", ts(4), ts(6))], PARENT)
    got = references.orphan_references(child, references.parent_keys(present, removed))
    # Equal times: a row removed at t is gone at t, one that arrives at t is there.
    assert rows(got, "row_key", "kind") == [("b", "late"), ("c", "removed"), ("d", "missing"), ("f", "missing"), ("h", "removed"), ("i", "late")]
    assert references.orphan_references(child, references.parent_keys(present.limit(0))).where("kind <> 'missing'").count() == 0
    assert references.orphan_references(child.limit(0), references.parent_keys(present)).count() == 0


def test_orphans_hot_key_brute_force(spark):
    rnd = random.Random(4)
    parents = {f"p{i}": (rnd.randrange(50), rnd.choice([None, rnd.randrange(100)])) for i in range(30)}
    child = [(str(i), "hot" if i % 3 == 0 else f"p{rnd.randrange(40)}", rnd.randrange(100)) for i in range(900)]
    parents["hot"] = (10, 60)
    want = []
    for k, fk, t in child:
        f = parents.get(fk)
        kind = "missing" if f is None else "removed" if f[1] is not None and f[1] <= t else "late" if f[0] > t else None
        want += [(k, kind)] if kind else []
    p = spark.createDataFrame([(k, ts(a), None if b is None else ts(b)) for k, (a, b) in parents.items()], PARENT)
    got = references.orphan_references(spark.createDataFrame([(k, fk, ts(t)) for k, fk, t in child], CHILD), references.parent_keys(p))
    assert rows(got, "row_key", "kind") == sorted(want)


# -- 2 ----------------------------------------------------------------------------------------
def flat(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "raw_id long, body string")
    bridge, objects = nested.flatten_objects(df, "raw_id", "body", COMPANY_BODY)
    return nested.owner_keys(nested.block_rows(bridge, COMPANY_BODY), objects, COMPANY_KEYS), objects


def test_nested_shapes(spark):
    one = {"reqSymbolInfo": {"symbol": "A", "tradeWindows": [{"n": 1}, None, {"n": 2}]}, "reqLogo": [None, {"secId": 7, "versions": []}, {"id": 2}], "reqSymbolBetaInfo": None}
    bodies = [json.dumps(one), json.dumps(json.dumps({"body": one})), json.dumps({"bodies": [None, one]}), json.dumps([one, {}]), "{", "", None, "7", '{"reqLogo":{"secId":NaN}}']
    found, objects = flat(spark, bodies)
    per = [("reqLogo", "1", "7"), ("reqLogo", "2", ""), ("reqSymbolInfo", "0", "A"), ("reqSymbolInfo", "0.0", "A"), ("reqSymbolInfo", "0.2", "A")]
    want = sorted((i, n, *p) for i, n in ((0, 0), (1, 0), (2, 1), (3, 0)) for p in per)
    assert rows(found, "record_id", "root_no", "block_name", "item_path", "key_value") == want
    # Every distinct object once, whatever the spelling of its keys: the company, its five objects, and {}.
    assert objects.count() == 7
    again, same = flat(spark, ['{"reqLogo":{"a":1,"b":{"c":[1]}}}', '{"reqLogo": {"b": {"c":[ 1 ]}, "a": 1}}'])
    assert same.count() == 3 and again.count() == 2
    assert flat(spark, [None])[0].count() == 0


def test_every_company_of_wrappers_in_lists_and_of_texts_in_texts(spark):
    company = lambda s: {"reqSymbolInfo": {"symbol": s}}
    deep = json.dumps(company("Z"))
    for _ in range(9):
        deep = json.dumps(deep)
    bodies = [json.dumps([{"body": [company("A"), company("B")]}, company("C")]), json.dumps([[company("A")]]), json.dumps({"bodies": [json.dumps(company("A")), "no json", None, company("B")]}), deep]
    found, _ = flat(spark, bodies)
    want = [(0, 0, "A"), (0, 1, "B"), (0, 2, "C"), (1, 0, "A"), (2, 0, "A"), (2, 3, "B"), (3, 0, "Z")]
    assert rows(found, "record_id", "root_no", "key_value") == want


def test_nested_long_and_copies(spark):
    big = json.dumps({"reqSymbolInfo": [{"symbol": "x" * 100_000, "tradeWindows": [{"n": i % 3} for i in range(3000)]}]})
    df = spark.createDataFrame([(1, big), (1, big)], "raw_id long, body string")
    bridge, objects = nested.flatten_objects(df, "raw_id", "body", COMPANY_BODY)
    assert bridge.count() == 3002 and objects.count() == 5
    assert bridge.where("depth = 2").select("parent_hash").distinct().count() == 1


def sorted_json(v):
    """Canonical JSON of a value in which numbers are texts marked by a bell, by a recursion of its own."""
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{sorted_json(v[k])}" for k in sorted(v)) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(sorted_json, v)) + "]"
    return v[1:] if isinstance(v, str) and v[:1] == "\a" else json.dumps(v, ensure_ascii=False)


def test_bodies_are_rebuilt_byte_for_byte(spark):
    rnd = random.Random(6)

    def value(depth):
        kind = rnd.randrange(9 if depth else 6)
        if kind < 6:
            return rnd.choice(["1", "1.0", "-0.10", "2E+5", "123456789012345678901234567890", "null", "true", '"a"', '"#"', '"\\ue0001"', '"\ue000"', '"\\\\ue000"', '"{\\"x\\":1}"', '"ස"', "[]", "{}"])
        if kind == 6:
            return "[" + ", ".join(value(depth - 1) for _ in range(rnd.randrange(4))) + "]"
        return "{ " + ",".join(f'"{k}" : {value(depth - 1)}' for k in rnd.sample(["#", "a", "b.c", r'd\"e', "ස", "[0]"], rnd.randrange(5))) + "}"

    bodies = [f'{{"reqLogo": {value(5)}, "history": {value(5)}}}' for _ in range(60)] + ['{"history":{}}', '{"history":[{}]}', '{"history":[[{}]]}']
    df = spark.createDataFrame(list(enumerate(bodies)), "raw_id long, body string")
    bridge, objects = nested.flatten_objects(df, "raw_id", "body", COMPANY_BODY)
    decode = lambda s: json.loads(s, parse_int="\a".__add__, parse_float="\a".__add__)
    content, got = {bytes(r["object_hash"]): decode(r["content"]) for r in objects.collect()}, bridge.collect()

    def rebuild(h):
        # Every object below the top of a content is a mark.
        fill = lambda v: rebuild(bytes.fromhex(v["#"])) if isinstance(v, dict) else [fill(x) for x in v] if isinstance(v, list) else v
        return {k: fill(v) for k, v in content[h].items()}

    tops = {r["record_id"]: bytes(r["object_hash"]) for r in got if r["path"] == "$"}
    assert all(sorted_json(rebuild(tops[i])) == sorted_json(decode(b)) for i, b in enumerate(bodies))
    # A lone object, a list of one and a list in a list are three contents.
    assert len({tops[60], tops[61], tops[62]}) == 3
    assert len({(r["record_id"], r["path"]) for r in got}) == len(got)


def test_every_nested_object_has_identity_parent_and_row(spark):
    stats = {"deals": [1], "deep": {"x": [[{"y": 1}], {"y": 1}]}}
    one = {"reqSymbolInfo": {"symbol": "A", "tradeWindows": [{"n": 1, "stats": stats}, None, {"n": 2, "stats": stats}]}, "reqTagsLogo": {"id": 1}, "reqLogo": [{"secId": 7, "v": {"id": 1}}]}
    df = spark.createDataFrame([(1, json.dumps(one)), (1, json.dumps(one)), (2, json.dumps(json.dumps({"bodies": [None, one]}))), (3, "{"), (4, None)], "raw_id long, body string")
    bridge, objects = nested.flatten_objects(df, "raw_id", "body", COMPANY_BODY)
    got, content = bridge.collect(), {bytes(r["object_hash"]): r["content"] for r in objects.collect()}
    assert len(got) == 2 * 15 and {(r["record_id"], r["root_no"]) for r in got} == {(1, 0), (2, 1)} and len(content) == 9
    assert all((r["parent_hash"] is None) == (r["depth"] == 0) and bytes(r["object_hash"]) in content for r in got)
    by = {r["path"]: r for r in got if r["record_id"] == 1}
    deep = by['$["reqSymbolInfo"]["tradeWindows"][2]["stats"]["deep"]["x"][0][0]']
    assert (deep["depth"], deep["field_name"], deep["places"]) == (5, "x", "0.0") and deep["object_hash"] == by['$["reqSymbolInfo"]["tradeWindows"][0]["stats"]["deep"]["x"][1]']["object_hash"]
    assert by['$["reqTagsLogo"]']["parent_hash"] == by["$"]["object_hash"] and by['$["reqTagsLogo"]']["object_hash"] == by['$["reqLogo"][0]["v"]']["object_hash"]
    assert nested.flatten_objects(df.limit(0), "raw_id", "body", COMPANY_BODY)[0].count() == 0


# -- 3 ----------------------------------------------------------------------------------------
def test_snapshot_changes(spark):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (4, 1, "a"), (4, 2, "c"), (4, 3, "d"), (6, 3, "d"), (6, None, "z"), (None, 1, "q"), (9, 1, None), (9, 3, None)]
    df = spark.createDataFrame(data, "s int, k long, v string")
    got = snapshots.snapshot_changes(df, "s", "k", F.col("v"))
    assert rows(got, "snapshot_no", "key", "change_kind") == [(4, 2, "changed"), (4, 3, "added"), (6, 1, "removed"), (6, 2, "removed"), (9, 1, "added"), (9, 3, "changed")]
    values = snapshots.change_values(got, df, "s", "k", F.col("v"))
    assert (4, 2, "b", "c") in rows(values.where("snapshot_no = 4 and key = 2"), "snapshot_no", "key", "value_before", "value_after")
    assert snapshots.snapshot_changes(df.limit(0), "s", "k", F.col("v")).count() == 0


def test_snapshot_brute_force_and_hot_key(spark):
    rnd = random.Random(1)
    data = [(s, k, rnd.choice("ab")) for s in (2, 3, 7, 8) for k in range(60) if rnd.random() < 0.7]
    want, by = set(), {s: {k: v for x, k, v in data if x == s} for s in (2, 3, 7, 8)}
    for a, b in ((2, 3), (3, 7), (7, 8)):
        want |= {(b, k, "added") for k in by[b].keys() - by[a].keys()} | {(b, k, "removed") for k in by[a].keys() - by[b].keys()} | {(b, k, "changed") for k in by[a].keys() & by[b].keys() if by[a][k] != by[b][k]}
    df = spark.createDataFrame(data + [data[0]] * 500, "s int, k long, v string").repartition(5)
    assert set(rows(snapshots.snapshot_changes(df, "s", "k", F.col("v")), "snapshot_no", "key", "change_kind")) == want


def test_listing_content(spark):
    texts = ['{"id": 1, "path": null, "fileText":"caf\\u00e9", "logoUrl":"x"}', '{"fileText" : "café","id":1,"path":null}', '{"id":1,"fileText":"café"}', "no json", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(listing.raw_content("t")).collect()]
    assert got[0] == got[1] == '{"fileText":"café","id":1,"path":null}' and got[2] != got[0] and got[3] == "no json" and got[4] is None


# -- 4 ----------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("text", "want"),
    [("1,227.6", ("1227.6", None, None)), ("(348 crore)", ("-348", 10**11, None)), ("2,65,109", ("265109", None, None)), ("19.282,66", ("19282.66", None, None)), ("6.312.566", ("6312566", None, None)),
     ("615 278", ("615278", None, None)), ("−42", ("-42", None, None)), ("42-", ("-42", None, None)), ("Rs. 16,549.05000s", ("16549.05", 10**7, "LKR")), ("9Billions Rs.", ("9", 10**13, "LKR")), ("-US$ 5 Mn", ("-5", 10**10, "USD")),
     ("0", ("0", None, None)), ("nil", None), ("-", None), ("", None), (None, None), ("7.81 %", None), ("68 per cent", None), ("Note 12", None), ("- -", None), ("N/A", None), ("9" * 5000, ("9" * 5000, None, None))],
)
def test_printed_amounts(text, want):
    number, unit, code = money.printed_amount(text)
    assert (None if number is None else (format(number, "f"), unit, code)) == want


def test_declared_units(spark):
    cols = "value_id long, raw_value string, label_raw string, reported_scale long, scale_evidence string, currency string, printed_decimals int, declared string"
    data = [
        (1, "12", "Revenue", 1000, "Rs Mn", "LKR", 0, "x"), (2, "12", "Revenue", None, "Rs Mn", None, 0, "x"), (3, "12 m", "Revenue (Rs '000)", 1000, None, "usd", 0, "x"), (4, "12", "Earnings per share (cents)", 1000, None, "LKR", 0, "x"),
        (5, "12", "Dividend in Rs.", 1000, None, None, 0, "x"), (6, "12", "Revenue", None, "Rs 000 | LKR million", "LKR", 0, "x"), (7, "12", "Revenue", None, None, "LKR", 0, "x"), (8, "12", "Revenue", 1000, None, None, 0, "x"),
        (9, "12", None, None, "රු. දහස්", None, 0, "x"), (10, None, None, None, None, None, None, None), (1, "12", "Revenue", 1000, "Rs Mn", "LKR", 0, "x"), (11, "0.125", "EPS (Rs cents)", None, None, None, 3, "x"), (12, "9" * 40, "a", 1, None, "LKR", 0, None), (13, "9" * 25, "a", 1, None, "LKR", 0, None), (14, "1" * 21, "a", 1, None, "LKR", 0, None), (15, "9" * 14, "a", 1, None, "LKR", 0, None),
    ]
    got = units.known_amounts(spark.createDataFrame(data, cols), "value_id")
    want = [(1, "LKR", 12 * 10**7), (2, "LKR", 12 * 10**10), (3, "LKR", 12 * 10**10), (4, "LKR", 1200), (5, "LKR", 12 * 10**4), (9, "LKR", 12 * 10**7), (11, "LKR", 13), (15, "LKR", (10**14 - 1) * 10**4)]
    assert rows(got, "value_id", "currency_code", "amount_e4") == want
    assert units.known_amounts(spark.createDataFrame([], cols), "value_id").count() == 0


def test_source_scales(spark):
    rng = np.random.default_rng(0)
    data = []
    for e in range(60):
        v = float(10 ** rng.uniform(6, 9))
        data += [(f"e{e}", "units", v), (f"e{e}", "thousands", v / 1e3 * rng.uniform(0.97, 1.03))]
        data += [(f"e{e}", "millions", v / 1e6)] if e % 2 else []
        data += [(None, "units", v), (f"e{e}", None, v), (f"e{e}", "units", None), (f"e{e}", "zero", 0.0)]
    df = spark.createDataFrame(data, "e string, s string, v double")
    got = units.source_scales(df, F.col("e"), F.col("s"), F.col("v"), spark.createDataFrame([("units", 0.0)], "source string, log10_scale double"))
    assert {r["source"]: r["log10_scale"] for r in got.collect()} == {"units": 0.0, "thousands": 3.0, "millions": 6.0}


def test_source_scales_long_chains_offsets_and_pairs_without_the_hub(spark):
    rng = np.random.default_rng(3)
    data = []
    for hop in range(6):  # s0 - s1 - ... - s6, each pair of neighbours on entities of its own
        for e in range(12):
            v = float(rng.uniform(1e6, 9e6))
            data += [(f"{hop}/{e}", f"s{hop}", v), (f"{hop}/{e}", f"s{hop + 1}", v / 1e3 if hop % 2 == 0 else v * 1e3)]
    for e in range(4):  # a pair that meets only where the largest source stands too, which it has no conversion to
        v = float(10 ** rng.uniform(6, 9))
        data += [(f"h{e}", "s0", v), (f"h{e}", "t", v / 1e6), (f"h{e}", "huge", float(rng.uniform(3, 4)) * 10 ** (3 * e)), (f"h{e}", "shifted", v / 1e3 + 5e8)]
    data += [(f"only{e}", "huge", 1.0) for e in range(500)]
    df = spark.createDataFrame(data, "e string, s string, v double")
    got = {r["source"]: r for r in units.source_scales(df, F.col("e"), F.col("s"), F.col("v"), spark.createDataFrame([("s0", 0.0)], "source string, log10_scale double")).collect()}
    assert {k: (r["log10_scale"], r["hops"]) for k, r in got.items() if k[0] == "s" and k != "shifted"} == {f"s{i}": (3.0 * (i % 2), i) for i in range(7)}
    assert got["t"]["log10_scale"] == 6.0 and abs(got["t"]["offset"]) < 1
    assert got["shifted"]["log10_scale"] == 3.0 and abs(got["shifted"]["offset"] + 5e11) < 1e6


def test_source_scales_refuse_pairs_that_do_not_agree(spark):
    rng = np.random.default_rng(5)
    data = [(f"e{e}", s, float(10 ** rng.uniform(3, 9))) for e in range(200) for s in ("units", "noise")] + [(f"e{e}", "twin", 2.0) for e in range(2)]
    df = spark.createDataFrame(data, "e string, s string, v double")
    got = units.source_scales(df, F.col("e"), F.col("s"), F.col("v"), spark.createDataFrame([("units", 0.0)], "source string, log10_scale double"))
    assert [r["source"] for r in got.collect()] == ["units"]


def test_scales_of_heading_texts_come_from_cells_that_the_reported_scale_states_too(spark, tmp_path):
    schema = "value_id long, raw_value string, label_raw string, reported_scale long, scale_evidence string, currency string, printed_decimals int, value_type string"
    row = lambda i, raw, scale, head, label="Revenue", kind="currency_amount": (i, raw, label, scale, head, "LKR", 0, kind)
    data = [row(i, f"({i}7)" if i % 2 else f"{i}7", 1000, "Wordless") for i in range(1, 7)] + [row(20, "55", None, "Wordless")]
    data += [row(30 + i, f"3{i},000", 10 ** (3 * i), "Mixed") for i in range(4)]
    data += [row(40, "41", 1000, "Rare"), row(41, "42", 1000, "Rare"), row(41, "42", 1000, "Rare")]
    data += [row(50 + i, f"5{i} mn", 1000, "Own unit") for i in range(4)] + [row(60 + i, f"6{i}", 1000, "Own label", "Revenue (Rs Mn)") for i in range(4)]
    data += [row(70 + i, f"7{i}", s, "Unscaled") for i, s in enumerate((0, -1000, None, 0))] + [row(80 + i, raw, 1, "No amounts") for i, raw in enumerate(("-", "0", "5%", None))]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/reported_values.parquet")
    got = {r["source"]: (r["log10_scale"], r["offset"], r["links"]) for r in problems.p4_source_scales(spark, str(tmp_path)).collect()}
    assert got == {"reported_scale:10000": (0.0, 0.0, 0), "heading:Wordless": (3.0, 0.0, 6)}


def test_long_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(1, "9" * 32, None, 1, None, "LKR", 0), (2, "9" * 33, None, 1, None, "LKR", 0), (3, "1" + "0" * 21 + ".125", None, 1, None, "LKR", 3)], "value_id long, raw_value string, label_raw string, reported_scale long, scale_evidence string, currency string, printed_decimals int")
    got = {r["value_id"]: r["declared"] for r in units.declared_amounts(df).collect()}
    assert format(got[1]["number"], "f") == "9" * 32 + ".000000" and got[2]["number"] is None and format(got[3]["number"], "f") == "1" + "0" * 21 + ".125000"
    assert [got[i]["amount_e4"] for i in (1, 2, 3)] == [None] * 3


# -- 5 ----------------------------------------------------------------------------------------
def test_redelivery_rules(spark):
    data = [(1, "a", ts(5)), (2, "a", ts(3)), (3, "a", ts(3)), (4, "b", None), (5, "b", ts(900)), (6, None, ts(1)), (7, None, ts(1)), (8, "c", ts(1))]
    df = spark.createDataFrame(data, "n long, k string, at timestamp").withColumn("_h", F.lit("clash")).withColumn("_tb", F.lit(0))
    got = redelivery.superfluous(df, [F.col("k")], "n", [F.col("at")], F.col("at"))
    assert rows(got, "n") == [(1,), (3,), (4,)]
    kept = redelivery.first_deliveries(df, [F.col("k")], "n", [F.col("at")], F.col("at"))
    assert rows(kept, "n") == [(2,), (5,), (6,), (7,), (8,)] and "_h" in kept.columns
    assert redelivery.superfluous(df.limit(0), [F.col("k")], "n", [F.col("at")], F.col("at")).count() == 0


def test_redelivery_brute_force_with_hot_message(spark):
    rnd = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else f"m{rnd.randrange(1500)}", rnd.choice([None, "x", "y"]), ts(rnd.randrange(800), rnd.randrange(3))) for i in range(3000)]
    best = {}
    for n, k, b, at in data:
        best[k, b] = min(best.get((k, b), (at, n)), (at, n))
    want = sorted((n,) for n, k, b, at in data if best[k, b] != (at, n))
    df = spark.createDataFrame(data, "n long, k string, b string, at timestamp").repartition(6)
    assert rows(redelivery.superfluous(df, [F.col("k"), F.col("b")], "n", [F.col("at")], F.col("at")), "n") == want


def test_redelivery_over_very_many_time_buckets(spark):
    rnd = random.Random(9)
    data = [(i, f"m{rnd.randrange(700)}", ts(rnd.randrange(0, 60_000) * 20)) for i in range(1200)]
    best = {}
    for n, k, at in data:
        best[k] = min(best.get(k, (at, n)), (at, n))
    df = spark.createDataFrame(data, "n long, k string, at timestamp")
    assert rows(redelivery.superfluous(df, [F.col("k")], "n", [F.col("at")], F.col("at")), "n") == sorted((n,) for n, k, at in data if best[k] != (at, n))


def test_bloom_has_no_false_negatives():
    for n in (3, 20_000):
        h = np.random.default_rng(3).integers(0, 2**63, n).astype(np.uint64)
        bloom = redelivery.Bloom(n)
        bloom.add(h)
        assert len(bloom.maybe(h)) == n and len(redelivery.Bloom(bits=bloom.bits.tobytes()).maybe(h)) == n
    assert len(bloom.maybe(np.random.default_rng(4).integers(0, 2**63, 20_000).astype(np.uint64))) < 400


def test_later_batches_open_only_buckets_that_answer(spark, tmp_path):
    rnd = random.Random(12)
    store, held = redelivery.IdentityStore(spark, f"file://{tmp_path}", 3), set()
    for no in range(4):
        # Batch 2 repeats messages of the years 2024 on only; those before lie in buckets of their own.
        names = [f"m{rnd.randrange(300)}" for _ in range(400)] if no != 1 else [f"old{i}" for i in range(50)]
        data = [(1000 * no + i, k, ts((-20_000 if k[0] == "o" else 0) + int(k.strip("mold")) * 3, rnd.randrange(5))) for i, k in enumerate(names)]
        best = {}
        for n, k, at in data:
            best[k] = min(best.get(k, (at, n)), (at, n))
        want = sorted((n,) for n, k, at in data if k in held or best[k] != (at, n))
        df = spark.createDataFrame(data, "n long, k string, at timestamp").repartition(3)
        again = [rows(store.surplus(no, df, [F.col("k")], "n", [F.col("at")], F.col("at")), "n") for _ in range(2)]
        assert again == [want, want]
        held |= set(names)
        if no == 1:  # whatever opens these buckets from here on fails
            for p in (tmp_path / "identities" / "_batch=1").rglob("*.parquet"):
                p.write_bytes(b"no parquet")
    assert store.surplus(4, df.limit(0), [F.col("k")], "n", [F.col("at")], F.col("at")).count() == 0


# -- 6 ----------------------------------------------------------------------------------------
def us(*a, minutes=0):
    return int((dt.datetime(*a) - dt.datetime(1970, 1, 1) - dt.timedelta(minutes=minutes)).total_seconds()) * 10**6


CASES = [
    ("01 Nov 2019 03:19:09 PM", None, us(2019, 11, 1, 15, 19, 9, minutes=330)), ("14Mar2010081442GMT", None, us(2010, 3, 14, 8, 14, 42)), (" 2018-01-11T10:32:28.971Z ", None, us(2018, 1, 11, 10, 32, 28) + 971000),
    ("16/02/2020 13:48", "UTC", us(2020, 2, 16, 13, 48)), ("07/10/2024 09:55 UTC+5:30", "UTC", us(2024, 10, 7, 9, 55, minutes=330)), ("June 8, 2025 11:04", "UTC", us(2025, 6, 8, 11, 4)), ("20180406020920", None, us(2018, 4, 6, 2, 9, 20, minutes=330)),
    ("1602000000", None, 1602000000 * 10**6), ("1602000000123", None, 1602000000123000), ("1602000000123456", None, 1602000000123456), ("1602000000123.0", None, 1602000000123000), ("2025-02-17", None, us(2025, 2, 17, minutes=330)),
    ("12 Aug 2015 12:29 am", "UTC", us(2015, 8, 12, 0, 29)), ("Sat, 23 Sep 2017 17:58:56 -0400", None, us(2017, 9, 23, 17, 58, 56, minutes=-240)), ("26 Dec 2021 02:22:38 AEDT", "UTC", us(2021, 12, 26, 2, 22, 38, minutes=660)),
    ("08 Mar 2020 02:30:00", "America/New_York", None), ("01 Nov 2020 01:30:00", "America/New_York", None), ("01 Nov 2020 01:30:00 EST", "America/New_York", us(2020, 11, 1, 1, 30, minutes=-300)), ("08 Mar 2020 03:30:00", "America/New_York", us(2020, 3, 8, 3, 30, minutes=-240)),
    ("31 Feb 2021 10:00:00 AM", None, None), ("25:61", None, None), ("00 000 0000", None, None), ("0000-00-00 00:00:00", None, None), ("to be announced", None, None), ("", None, None), (None, None, None), ("2020-01-01 10:00 XYZ", None, None),
    ("nonsense, 12 Jan 2024", None, None), ("Monday, 12 Jan 2024", "UTC", None), ("Friday, 12 Jan 2024", "UTC", us(2024, 1, 12)), ("fri 12 jan 2024 10:00", "UTC", us(2024, 1, 12, 10)), ("Frid, 12 Jan 2024", "UTC", None), ("Thurs. January 11, 2024", "utc", us(2024, 1, 11)), ("mon, Jan 11, 2024", "UTC", None), ("Wed 31 Dec 1969 10:00", "UTC", us(1969, 12, 31, 10)),
    ("2024-01-12 10:00", "Singapore", us(2024, 1, 12, 10, minutes=480)), ("2024-01-12 10:00", "asia/colombo", us(2024, 1, 12, 10, minutes=330)), ("2024-01-12 10:00", " EST5EDT ", us(2024, 1, 12, 10, minutes=-300)), ("2024-01-12 10:00", "Factory", None), ("12 Septem 2024", None, None), ("12 sept 2024", "UTC", us(2024, 9, 12)), ("\u000112 sept 2024", "UTC", us(2024, 9, 12)),
    ("2020-01-01 10:00", "No/Where", None), ("13/13/2020", None, None), ("2020-01-01 13:00 pm", None, None), ("x" * 100_000, None, None), ("29.02.2020 23:59", "Europe/London", us(2020, 2, 29, 23, 59)),
]


def test_instants(spark):
    df = spark.createDataFrame([(i, t, z, "clash") for i, (t, z, _) in enumerate(CASES)], "i int, t string, z string, _s string")
    got = {r["i"]: r["u"] for r in instants.with_utc_micros(df, "t", "z", "u").collect()}
    assert [(CASES[i][0] or "")[:40] for i in got if got[i] != CASES[i][2]] == []
    first = instants.with_utc_micros(df.where("i = 16"), "t", "z", "u", ambiguous="first").first()["u"]
    second = instants.with_utc_micros(df.where("i = 16"), "t", "z", "u", ambiguous="second").first()["u"]
    assert second - first == 3600 * 10**6 and first == us(2020, 11, 1, 1, 30, minutes=-240)
    assert instants.with_utc_micros(df.limit(0), "t", None, "u").count() == 0


def test_every_zone_name_is_known_to_the_engine(spark):
    names = [*instants._known_zones(), *instants._known_zones().values(), "ROC"]
    df = spark.createDataFrame([(i, "2024-01-12 10:00", z) for i, z in enumerate(names)], "i int, t string, z string")
    assert instants.with_utc_micros(df, "t", "z", "u").where("u is null").collect() == []


# -- 7 ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("state", ["latest", "highest"])
def test_known_at_brute_force_with_hot_entity(spark, state):
    rnd = random.Random(11)
    changes = [(1 if i % 3 == 0 else rnd.randrange(2, 60), rnd.randrange(0, 5000), rnd.randrange(10**6)) for i in range(2400)]
    events = [(i, 1 if i % 3 == 0 else rnd.randrange(2, 70), rnd.randrange(-50, 6000)) for i in range(900)]
    hours = lambda h: T0 + dt.timedelta(hours=h)
    want = []
    for i, e, t in events:
        seen = [(at, r) for k, at, r in changes if k == e and at <= t]
        own = [(at, r) for k, at, r in changes if k == e]
        pick = (lambda x: max(x)[1]) if state == "latest" else (lambda x: max(r for _, r in x))
        want.append((i, pick(seen) if seen else -1, pick(own) if own else -1))
    c = spark.createDataFrame([(k, hours(a), r) for k, a, r in changes] + [(None, hours(0), 5), (1, None, 10**9)], "e long, at timestamp, r long")
    v = spark.createDataFrame([(i, e, hours(t), "c") for i, e, t in events], "i long, e long, t timestamp, _rank string")
    got = pit_join.known_at(v, c, "e", "t", "at", ["r"], state, "final_")
    assert sorted((x["i"], -1 if x["r"] is None else x["r"], -1 if x["final_r"] is None else x["final_r"]) for x in got.collect()) == sorted(want)
    assert "_rank" in got.columns


@pytest.mark.parametrize("state", ["latest", "highest"])
def test_known_at_with_bursts_splits_buckets(spark, state, monkeypatch):
    """Thousands of versions within seconds, long gaps between bursts, and entities that are not split."""
    monkeypatch.setattr(pit_join, "VERSIONS_PER_BUCKET", 4)
    rnd = random.Random(21)
    times = lambda e: rnd.choice([0, 10**6, 10**13, 9 * 10**14]) + rnd.randrange(400) if e == 1 else rnd.randrange(10**15)
    changes = [(e, times(e), rnd.randrange(10**6)) for e in [1] * 1500 + [rnd.randrange(2, 9) for _ in range(200)]]
    events = [(i, e, times(e) + rnd.choice([-1, 0, 1, 10**8])) for i, e in enumerate([1] * 400 + [rnd.randrange(2, 10) for _ in range(200)])]
    full = pit_join._full_buckets(spark.createDataFrame(list({(e, t) for e, t, _ in changes}), "_e long, _from long"))
    assert len(full) == 8 and full[-1].count() > 10
    at = lambda t: F.timestamp_micros(t)
    c = spark.createDataFrame(changes, "e long, u long, r long").withColumn("at", at("u"))
    v = spark.createDataFrame(events, "i long, e long, u long").withColumn("t", at("u"))
    want = []
    for i, e, t in events:
        seen, own = [(u, r) for k, u, r in changes if k == e and u <= t], [(u, r) for k, u, r in changes if k == e]
        pick = (lambda x: max(x)[1] if x else -1) if state == "latest" else (lambda x: max((r for _, r in x), default=-1))
        want.append((i, pick(seen), pick(own)))
    got = pit_join.known_at(v, c, "e", "t", "at", ["r"], state, "final_")
    assert sorted((x["i"], -1 if x["r"] is None else x["r"], -1 if x["final_r"] is None else x["final_r"]) for x in got.collect()) == sorted(want)


def test_known_at_edges(spark):
    c = spark.createDataFrame([(1, ts(1), 5), (1, ts(1), 7), (1, ts(3), 6)], "e long, at timestamp, r long")
    v = spark.createDataFrame([(0, 1, ts(1)), (1, 1, ts(1, -1)), (2, 1, ts(3)), (3, None, ts(3)), (4, 1, None), (5, 2, ts(3)), (6, 1, dt.datetime(9999, 1, 1)), (6, 1, dt.datetime(9999, 1, 1))], "i long, e long, t timestamp")
    got = pit_join.known_at(v, c, "e", "t", "at", ["r"])
    assert sorted((x["i"], x["r"] or -1) for x in got.collect()) == [(0, 7), (1, -1), (2, 6), (3, -1), (4, -1), (5, -1), (6, 6), (6, 6)]
    assert pit_join.known_at(v, c.limit(0), "e", "t", "at", ["r"]).where("r is not null").count() == 0
    assert pit_join.known_at(v.limit(0), c, "e", "t", "at", ["r"]).count() == 0


def test_no_leakage(spark):
    """What is known at T does not change when everything later is taken away."""
    rnd = random.Random(3)
    changes = [(rnd.randrange(20), rnd.randrange(400), rnd.randrange(1000)) for _ in range(500)]
    mk = lambda x: spark.createDataFrame([(k, ts(a), r) for k, a, r in x], "e long, at timestamp, r long")
    for t in (50, 200, 399):
        v = spark.createDataFrame([(e, ts(t)) for e in range(20)], "e long, t timestamp")
        full = rows(pit_join.known_at(v, mk(changes), "e", "t", "at", ["r"]), "e", "r")
        assert full == rows(pit_join.known_at(v, mk([x for x in changes if x[1] <= t]), "e", "t", "at", ["r"]), "e", "r")
