"""Edge cases and brute force for the ordered, evidence, range, listing, text and streaming operators."""

import datetime as dt
import itertools
import json
import os
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracewell.functions import records, texts
from tracewell.operators import evidence, ordered, ranges
from tracewell.plans import reference, reference_more, reference_rest, reference_text
from tracewell.sources import listings, shared
from tracewell.streaming import capture

T0 = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


OBS = "e int, field string, tolerance string, source string, capture_window string, observed_at timestamp, obs_id long, value decimal(18,2)"


def observe(spark, *items):
    return spark.createDataFrame([(1, f, t, s, w, T0 + dt.timedelta(hours=h), i, None if v is None else Decimal(v)) for i, (f, t, s, w, h, v) in enumerate(items)], OBS)


def reconcile(df):
    return {r["field"]: r for r in evidence.reconcile_fields(df, ["e"], ["A", "B"], ["close"]).collect()}


def test_precedence_then_recency(spark):
    got = reconcile(observe(spark, ("close", "pct", "B", "post_close", 9, "10"), ("close", "pct", "A", "post_close", 5, "10"), ("close", "pct", "Z", "post_close", 20, "10")))
    assert (got["close"]["source"], got["close"]["state"], got["close"]["n_candidates"]) == ("A", "settled", 3)


def test_intraday_never_finalises_and_zero_is_kept(spark):
    got = reconcile(observe(spark, ("close", "pct", "A", "post_open", 1, "10"), ("volume", "exact", "A", "post_close", 2, "0"), ("volume", "exact", "A", "post_close", 3, None)))
    assert got["close"]["state"] == "not_yet_available" and got["close"]["value"] is None
    assert got["volume"]["value"] == 0 and got["volume"]["n_candidates"] == 1


def test_moving_value_is_superseded_but_another_source_disagrees(spark):
    moved = reconcile(observe(spark, ("volume", "exact", "A", "post_open", 1, "5"), ("volume", "exact", "A", "post_close", 2, "9")))
    assert (moved["volume"]["state"], moved["volume"]["n_superseded"], moved["volume"]["value"]) == ("settled", 1, 9)
    clash = reconcile(observe(spark, ("close", "pct", "A", "post_close", 1, "100"), ("close", "pct", "B", "post_close", 2, "100.05"), ("close", "pct", "Z", "post_close", 2, "101")))
    assert (clash["close"]["state"], clash["close"]["n_alternates"]) == ("discrepancy", 2)


def test_facts_against_all_pairs(spark):
    rnd = random.Random(5)
    data = [(f, rnd.randrange(3), Decimal(rnd.randrange(90, 110)), Decimal(rnd.choice([1, 2, 5])), i) for i, f in enumerate(rnd.randrange(80) for _ in range(300))]
    data.append((999, 1, None, Decimal(1), 1000))
    got = {r["fact"]: r for r in evidence.reconcile_facts(spark.createDataFrame(data, "fact int, doc int, v decimal(10,2), h decimal(10,2), o int"), "fact", "doc", "v", "h", ["doc", "o"]).collect()}
    assert 999 not in got
    for f, r in got.items():
        m = [x for x in data if x[0] == f]
        bad = any(abs(a[2] - b[2]) > a[3] + b[3] for a, b in itertools.combinations(m, 2))
        docs = {x[1] for x in m}
        assert r["state"] == ("conflicting" if bad else "single_source" if len(docs) == 1 else "corroborated")
        finest = [x for x in m if x[3] == min(y[3] for y in m)]
        same = len({x[2] for x in finest}) == 1
        assert r["representative"] == (finest[0][2] if same and not bad else None)
        assert (r["low"], r["high"]) == ((None, None) if bad else (max(x[2] - x[3] for x in m), min(x[2] + x[3] for x in m)))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_partitioning_gives_the_same(spark, seed):
    rnd = random.Random(seed)
    items = [("close", "pct", rnd.choice("ABZ"), rnd.choice(["post_open", "post_close"]), rnd.randrange(3), str(rnd.randrange(99, 102))) for _ in range(30)]
    df = observe(spark, *items)
    want = rows(evidence.reconcile_fields(df, ["e"], ["A", "B"], ["close"]))
    assert rows(evidence.reconcile_fields(df.repartition(7).orderBy(F.rand(seed)), ["e"], ["A", "B"], ["close"])) == want


def test_visible_evidence_modes(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, None, 1), (3, 5, 1), (4, 1, 5), (5, 1, None)], "i int, a int, k int")
    see = lambda m, t, h: [r[0] for r in rows(evidence.visible_evidence(df, m, "a", "k", None if t is None else F.lit(t), None if h is None else F.lit(h)), "i")]
    assert see("known", 1, None) == [1, 2] and see("available", 1, 5) == [1, 4] and see("current", None, 1) == [1, 2, 3] and see("recorded", 1, None) == [1, 2, 3]
    with pytest.raises(ValueError, match="cutoff"):
        see("available", 1, None)


def test_listing_merge_counts_a_null_of_the_first_provider(spark):
    df = spark.createDataFrame([(1, {"p": None, "q": "x"}, 0), (1, {"p": "b"}, 1), (1, {"q": "y"}, 2), (2, {"t": "1000000"}, 0), (2, {"t": "1999999"}, 1), (2, {"t": "2000000"}, 2), (2, {"t": None}, 3), (3, None, 0)], "k int, item map<string,string>, r int")
    assert rows(evidence.merge_listing_fields(df, "k", ["p", "q", "t", "z"], [F.col("r")], {"t": 1_000_000})) == [(1, 3, None, "x", None, None, 2), (2, 4, None, None, "1000000", None, 2), (3, 1, None, None, None, None, 0)]


def test_listing_sources_and_their_order(spark, tmp_path):
    """Spellings of one source are one source; annual comes before quarterly; A, B, A is a change back."""
    item = lambda path, at: json.dumps({"id": 7, "path": path, "uploadedDate": at, "fileText": None})
    data = [
        (1, 7, "/api/financials", "QUARTERLY", "Q", item("q", 1_600_000_000_000), 1), (2, 7, "financials ", "infoQuarterlyData", "Q", item("q2", 1_600_000_000_000), 2), (3, 7, "financials", "quarterly", "Q", item("q", 1_600_000_000_000), 3),
        (4, 7, "getFinancialAnnouncement", None, None, item("f", "13 Sep 2020 05:56:40 PM"), 4), (5, 7, "getFinancialAnnouncement", "", None, item("f", "13 Sep 2020 05:56:40 PM"), 5),
        (6, 7, "financials", "annual", "Z", item("a", 1_600_000_000_999), 6), (7, 7, "financials", "other", None, item("o", 1_600_000_001_000), 7),
    ]
    df = spark.createDataFrame(data, "delivery_no long, cse_filing_id long, source_endpoint string, source_bucket string, query_symbol string, raw_item string, n int")
    df.withColumns({"observed_at": F.timestamp_seconds("n"), "metadata_hash": F.lit(None).cast("string")}).write.parquet(f"{tmp_path}/filing_observations.parquet")
    got = {r["delivery_no"]: r["outcome"] for r in reference_rest.d5_observation_outcomes(spark, str(tmp_path)).collect()}
    assert got == {1: "new_filing", 2: "metadata_changed", 3: "metadata_changed", 4: "new_source", 5: "unchanged", 6: "new_source", 7: "new_source"}
    merged = reference.d5_listing_merge(spark, str(tmp_path)).first()
    # Three paths differ from the annual one; of the times only that of the bucket other is a second away.
    assert (merged["n_sources"], merged["path"], merged["uploadedDate"], merged["n_differences"]) == (4, "a", 1_600_000_000_999_000, 4 - 1)


def test_digest_is_independent_of_order_and_partitions(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else "x" * (i % 7)) for i in range(500)], "a int, b string")
    one = ordered.table_digest(df).first()
    assert ordered.table_digest(df.repartition(9).orderBy("b")).first() == one
    assert ordered.table_digest(df.where("a <> 3")).first() != one


def test_digest_tells_rows_apart(spark):
    kinds = "a string, b string, c double, d array<string>"
    cases = [("a|b", "c", 1.0, ["x"]), ("a", "b|c", 1.0, ["x"]), (None, "c", 1.0, ["x"]), ("~", "c", 1.0, ["x"]), ("-", "c", 1.0, ["x"]), ("", "c", 1.0, ["x"]), ("a", "c", 1.0000000001, ["x"]), ("a", "c", 1e300, ["x"]), ("a", "c", None, ["x"]), ("a", "c", 1.0, []), ("a", "c", 1.0, None), ("a", "c", 1.0, [None]), ("a", "c", 1.0, ["x", "y"]), ("a", "c", 1.0, ["xy"])]
    got = [tuple(ordered.table_digest(spark.createDataFrame([c], kinds)).first()) for c in cases]
    assert len(set(got)) == len(cases)
    assert tuple(ordered.table_digest(spark.createDataFrame([], kinds)).first()) == (0,) + (0,) * 8


def test_order_statistics_brute_force(spark):
    import statistics

    rnd = random.Random(2)
    data = [("hot" if i % 3 == 0 else rnd.choice("ab"), rnd.randrange(40)) for i in range(900)] + [("a", None)] + [(f"n{n}", rnd.randrange(50)) for n in range(1, 27) for _ in range(n)]
    for r in ordered.order_statistics(spark.createDataFrame(data, "k string, v long"), "k", "v").collect():
        v = sorted(x for k, x in data if k == r["k"] and x is not None)
        n = len(v)
        assert (r["least"], r["most"], r["median"], r["p90"]) == (v[0], v[-1], statistics.median(v), v[min(n - 1, round(0.9 * (n - 1)))])


@pytest.mark.parametrize("hot", [10**9, 40])
def test_previous_rows_of_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(ordered, "HOT_ROWS", hot)
    rnd = random.Random(4)
    data = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{rnd.randrange(30)}", i * 7919 % 1000, rnd.choice([None, 1, 2, 3])) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(5)
    got = ordered.with_previous(df, ["k"], ["o"], ["v", "o"], ["v"], ["v"]).collect()
    assert len(got) == 1000
    for r in got:
        before = sorted((o, v) for k, o, v in data if k == r["k"] and o < r["o"])
        known = [v for _, v in before if v is not None]
        assert r["_seq"] == len(before) + 1 and r["_known_v"] == (known[-1] if known else None) and r["_before_v"] == (sum(known) if known else None)
        assert (None if r["_prev"] is None else (r["_prev"]["o"], r["_prev"]["v"])) == (before[-1] if before else None)


@pytest.mark.parametrize("hot", [10**9, 40])
def test_touching_pairs_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(ordered, "HOT_ROWS", hot)
    rnd = random.Random(8)
    spans = [(rnd.choice([1, 1, 2, 3]), a := rnd.randrange(60), a + rnd.randrange(-2, 8)) for _ in range(200)] + [(4, 1, 2), (5, None, 3)]
    got = {r["k"]: (r["n_pairs"], r["n_agreeing"]) for r in ranges.touching_pairs(spark.createDataFrame(spans, "k int, a int, b int"), "k", F.col("a"), F.col("b")).collect()}
    for k in (1, 2, 3, 4, 5):
        own = [(a, b) for x, a, b in spans if x == k and a is not None and a <= b]
        pairs = list(itertools.combinations(own, 2))
        assert got.get(k) == ((len(pairs), sum(max(p[0], q[0]) <= min(p[1], q[1]) for p, q in pairs)) if pairs else None)


def test_order_violations_and_constraints(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 0, 5), ("b", 2, 5)], "k string, o int, v int")
    assert rows(ordered.order_violations(df, ["k"], "o", ["v"])) == [("a", 0, True), ("b", 1, False)]
    checks = spark.createDataFrame([(1, None), (2, 5), (3, -1)], "i int, v int")
    assert rows(ordered.constraint_violations(checks, "i", {"positive": F.col("v") > 0, "small": F.col("v") < 5})) == [(2, "small"), (3, "positive")]


def test_active_per_day(spark):
    d = lambda n: dt.date(2024, 1, n)
    spans = [(d(1), d(3)), (d(3), d(3)), (d(6), d(7)), (d(5), d(2)), (None, d(9)), (d(1), None)]
    got = dict(rows(ranges.active_per_day(spark.createDataFrame(spans, "a date, b date"), "a", "b", "day", "n")))
    assert got == {d(n): sum(a is not None and b is not None and a <= d(n) <= b for a, b in spans) for n in range(1, 8)}
    assert ranges.active_per_day(spark.createDataFrame([], "a date, b date"), "a", "b", "day", "n").count() == 0


def test_payload_readers(spark):
    df = spark.createDataFrame([(1, '[{"a":1},null,3]'), (2, '{"x":1,"rows":[{"a":2}],"z":[]}'), (3, '{"x":1}'), (4, "broken"), (5, None)], "i int, b string")
    assert rows(listings.row_list(df, "b"), "i", "pos", F.to_json("element")) == [(1, 0, '{"a":1}'), (1, 1, "null"), (1, 2, "3"), (2, 0, '{"a":2}')]
    blocks = spark.createDataFrame([(1, '{"b":{"s":1,"n":2},"a":{"s":1}}'), (2, '{"b":{"s":1},"a":{"n":1}}'), (3, '{"a":{"q":1}}'), (4, "x")], "i int, b string")
    assert rows(listings.best_block(blocks, "b", ["s", "n"]), "i", "block", "score", "ambiguous") == [(1, "b", 2, False), (2, "b", 1, True), (3, None, 0, False), (4, None, 0, False)]
    # The order of the document decides, not that of the keys.
    two = spark.createDataFrame([(1, '{"zeta":[1,2],"alpha":[3]}'), (2, '{"n":1,"s":"[9]","zeta":{"a":[1]},"list":[]}')], "i int, b string")
    assert rows(listings.row_list(two, "b"), "i", "pos", F.to_json("element")) == [(1, 0, "1"), (1, 1, "2")]
    tie = spark.createDataFrame([(1, '{"zeta":{"s":1},"list":[{"s":1,"n":2}],"alpha":{"n":1}}')], "i int, b string")
    assert rows(listings.best_block(tie, "b", ["s", "n"]), "block", "score", "ambiguous") == [("zeta", 1, True)]


def test_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["１２", "-", " Nil ", "N/A", "", "5 %", "see note", None, "Note 12"])], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(texts.value_state("t")).collect()] == ["numeric", "reported_nil", "nil_word", "not_applicable", "blank", "percentage", "not_a_number", None, "not_a_number"]
    cases = [None, " ", "/a", "a/../b", "a.", "a b", "a\nb", "http://x", "a/b.pdf", " a", "a//b", "a\\b", "upload_report_file/x y.pdf"]
    paths = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").orderBy("i")
    want = ["null", "blank", "not_relative", "empty_or_relative_segment", "trailing_dot", "ok", "control_character", "not_relative", "ok", "outer_white_space", "empty_or_relative_segment", "not_relative", "ok"]
    assert [r[0] for r in paths.select(texts.accepted_path("t")).collect()] == want
    assert [r[0] for r in paths.where("i in (0, 5, 12)").select(texts.path_candidates("t")).collect()] == [[], ["a%20b"], ["upload_report_file/x%20y.pdf", "cmt/upload_report_file/x%20y.pdf"]]
    found = spark.createDataFrame([('{"a":[{"Status":1},{"b":{"status":null}}]}',), ("{",), (None,)], "t string").select(texts.field_paths("t", "status")).collect()
    assert [r[0] for r in found] == [["a.0.Status", "a.1.b.status"], [], []]


def test_late_rows_change_what_was_derived(spark, tmp_path):
    schema = "k int, n int, v string"
    src = f"{tmp_path}/in"
    spark.createDataFrame([(1, 5, "new"), (2, 1, "only")], schema).coalesce(1).write.parquet(src)
    derive = lambda log: ordered.latest_per_key(log, ["k"], [F.desc("n")])

    def drain():
        stream = capture.read_events(spark, src, spark.read.parquet(src).schema, 10)
        capture.rederive(stream, derive, f"{tmp_path}/log", f"{tmp_path}/out", "k", f"{tmp_path}/cp").awaitTermination()

    drain()
    spark.createDataFrame([(1, 3, "late")], schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(1, 9, "newest")], schema).coalesce(1).write.mode("append").parquet(src)
    drain()
    out = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    now = ordered.latest_per_key(out, ["k"], [F.desc("_batch")])
    assert rows(now, "k", "v") == [(1, "newest"), (2, "only")]
    assert spark.read.parquet(f"{tmp_path}/log").count() == 4


def test_bodies_and_reports(spark, tmp_path):
    import base64
    import hashlib

    from tracewell.sources import bodies

    def body(text):
        return base64.b64encode(text.encode()).decode(), hashlib.sha256(text.encode()).hexdigest()

    good = spark.createDataFrame([(1, *body("a")), (2, *body("සිංහල"))], "i int, b string, h string")
    assert rows(bodies.with_verified_body(good, "b", "h"), "i", "body") == [(1, "a"), (2, "සිංහල")]
    bad = good.unionByName(spark.createDataFrame([(3, body("x")[0], body("y")[1]), (4, None, body("z")[1])], "i int, b string, h string"))
    assert rows(bodies.mismatched_bodies(bad, "b", "h"), "i") == [(3,), (4,)]
    with pytest.raises(Exception, match="does not match"):
        bodies.with_verified_body(bad, "b", "h").collect()
    bodies.write_report(spark.createDataFrame([(1, None)], "i int, s string").coalesce(1), f"{tmp_path}/r")
    assert rows(listings.read_jsonl(spark, f"{tmp_path}/r", "i int, s string")) == [(1, None)]
    assert any('"s":null' in line[0] for line in spark.read.text(f"{tmp_path}/r").collect())


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_missing_pairs_brute_force_and_hot_key(spark, block):
    rnd = random.Random(4)
    held = {k: [rnd.randrange(-1, n + 2) for _ in range(n)] for k, n in ((1, 1), (2, 2), (3, 7), (4, 9), (5, 17), (None, 4))}
    held |= {6: list(range(12)), 7: [0] * 100 + [None, 3]}  # complete, and hot
    df = spark.createDataFrame([(k, o) for k, os in held.items() for o in os], "k long, o int")
    want = [(k, i, j) for k, os in held.items() for j in range(len(os)) for i in range(j) if i not in os or j not in os]
    got = [tuple(r) for r in ranges.missing_pairs(df, "k", F.col("o"), block).collect()]
    assert sorted((x for x in got if x[0] is not None)) == sorted(x for x in want if x[0] is not None) and sorted(x[1:] for x in got if x[0] is None) == sorted(x[1:] for x in want if x[0] is None)
    assert ranges.missing_pairs(df.limit(0), "k", F.col("o"), block).count() == 0


def test_redaction_of_whole_texts(spark):
    amounts = (r"(?<![\w.,/-])\(?-?\d{1,3}(?:,\d{3})+(?:\.\d+)?\)?(?![\w,/-])", r"(?<![\w.,/-])\(?-?\d+\.\d+\)?%?(?![\w./-])", r"(?<![\w.,/-])-?\d+(?:\.\d+)?\s?%", r"(?<![\w.,/-])\d{5,}(?![\w.,/-])", r"(?:^|(?<=\s))[,.]\d[\d,.]*")

    def want(text):
        s = re.sub(r"\s+", " ", text or "").strip()
        for p in amounts:
            s = re.sub(p, "#", s)
        return s

    rnd = random.Random(2)
    parts = ["1,234", "(12,000.50)", "4.6%", "12 %", "31.12.2024", "2024", "123456", "a", "é5", "-7.25", ",5", ".7", "/", "-", " ", "\x1c", "\t", "  ", " ", " ", " ", "٣٫٥", "٣,٤٥٦", "12/03/2024", "Rs.", "\U0001f600", "9", "(3)", "́", "²"]
    cases = [None, "", " ", "x " * 100 + "1,234 end"] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 60))) for _ in range(800)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").select("i", texts.redacted("t").alias("r")).collect()
    assert {r["i"]: r["r"] for r in got} == {i: want(t) for i, t in enumerate(cases)}


def test_redaction_query_reads_past_the_opening(spark, tmp_path):
    opening = "same opening " * 20
    data = [(opening + "one 12,345",), (opening + "one 99,999",), (opening + "two",), (None,), ("a" + " " * 200 + "b 1,000",)]
    spark.createDataFrame(data, "text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(reference_more.x17_redaction(spark, str(tmp_path)), "snippet", "n")
    assert got == sorted([("", 1), ("a b #", 1), (opening[:160], 2), (opening[:160], 1)])


def test_every_isin_of_a_body(spark, tmp_path):
    body = {"bodies": [{"reqSymbolInfo": {"isin": "ZZ0001N1"}}, {"reqSymbolInfo": {"isin": "ZZ0001X2"}}, {"reqSymbolInfo": {"isin": "ZZ0002N3"}}]}
    once = json.dumps(body, indent=1)
    data = [(1, once), (1, once), (2, json.dumps(once)), (3, json.dumps(json.dumps(json.dumps({"isin": "ZZ0003N1"})))), (4, None), (5, "{}")]
    spark.createDataFrame(data, "raw_id long, body string").write.parquet(f"{tmp_path}/company_info_raw.parquet")
    assert rows(reference_text.x22_issuer_codes(spark, str(tmp_path)), "issuer_code", "n_bodies", "n_isins") == [("0001", 2, 2), ("0002", 2, 1), ("0003", 1, 1)]


def test_shared_folder_is_refused_off_a_local_master(tmp_path):
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = Conf(conf), type("C", (), {"master": master, "setCheckpointDir": lambda _, d: None})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session("spark://host:7077"))
    assert shared.shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    assert shared.shared_dir(Session("local[2]")).startswith("file:///")


def test_scratch_removes_what_was_written_inside(spark):
    kept = shared.materialize(spark.range(3), "kept")
    with shared.scratch():
        inside = shared.materialize(spark.range(5), "inside")
        assert inside.count() == 5
        path = inside.inputFiles()[0]
    assert kept.count() == 3 and not os.path.exists(path.removeprefix("file://"))


def test_date_tokens(spark):
    cases = {
        "as at 31st March 2024 and 31.12.2023": [("full", 2024, 3, 31), ("full", 2023, 12, 31)], "3st March 2024": [], "31 Feb 2021": [("year", 2021, None, None)], "March 5, 2020 / 12-Jan-19": [("full", 2020, 3, 5), ("full", 2019, 1, 12)],
        "ended 30 June": [("month_day", None, 6, 30)], "June 30": [("month_day", None, 6, 30)], "30 Feb": [], "29 February": [("month_day", None, 2, 29)], "Yearly Report 2024/25": [], "Report 2024": [("year", 2024, None, None)], "2 025": [("year", 2025, None, None)],
        "12,345 and 1.5": [], "05/13/2020": [], "11th Sept 2019": [("full", 2019, 9, 11)], "": [], "13.14.15": [], "31st March 2024 2023": [("full", 2024, 3, 31), ("year", 2023, None, None)],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None])], "i int, t string").orderBy("i")
    got = [[(x["kind"], x["year"], x["month"], x["day"]) for x in r[0]] for r in df.select(texts.date_tokens("t")).collect()]
    assert got == [*cases.values(), []]


def test_duration_phrases(spark):
    cases = {"for the nine months and the quarter": (9, "9M"), "quarter and 12 months": (3, "quarter"), "Half-Year to June": (6, "6M"), "financial year ended": (12, "12M"), "03months": (3, "3M"), "period ended": (None, "unspecified"), "yearly": None, "months": None, "": None}
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None])], "i int, t string").orderBy("i")
    assert [None if r[0] is None else tuple(r[0]) for r in df.select(texts.duration_phrase("t")).collect()] == [*cases.values(), None]


def test_fetch_outcomes_in_order(spark):
    ok = '{"a":{}}'
    cases = [
        ("timeout", 200, "x", ok, "timeout"), ("too_large", None, "x", None, "too_large"), ("network", None, "x", None, "network_error"), (None, 403, "x", ok, "blocked"), (None, 429, "x", "", "rate_limited"), (None, 503, "x", ok, "server_error"), (None, 302, "x", ok, "unexpected_redirect"),
        (None, None, "x", ok, "http_error"), (None, 404, "x", ok, "http_error"), (None, 200, "companyInfoSummery", " \n", "empty_response"), (None, 200, "companyInfoSummery", "{", "invalid_json"), (None, 200, "companyInfoSummery", "[]", "malformed_response"), (None, 204, "companyInfoSummery", ok, "ok"),
        (None, 200, "tradeSummary", ok, "malformed_response"), (None, 200, "tradeSummary", '{"x":[]}', "ok"), (None, 200, "allSecurityCode", '[{"Symbol":"A"}]', "ok"), (None, 200, "allSecurityCode", '{"x":[{"symbol":""}]}', "malformed_response"), (None, 200, "unknown", ok, "malformed_response"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, k string, s int, e string, b string, want string").orderBy("i")
    assert [(r[0], r[1]) for r in df.select(records.fetch_outcome("k", "s", "e", "b"), "want").collect() if r[0] != r[1]] == []


def test_retry_after(spark):
    cases = {"120": 120.0, " 7 ": 7.0, "Mon, 01 Jan 2024 00:01:30 GMT": 90.0, "Sun, 31 Dec 2023 23:00:00 GMT": 0.0, "soon": None, "-5": None}
    df = spark.createDataFrame([(i, h, T0) for i, h in enumerate([*cases, None])], "i int, h string, now timestamp").orderBy("i")
    assert [r[0] for r in df.select(records.retry_after_seconds("h", "now")).collect()] == [*cases.values(), None]


def test_printed_classes(spark):
    cases = {
        "1,234.50": ("numeric", "1234.500000", 2), "+.5": ("numeric", "0.500000", 1), "1,23": ("unresolved", None, None), "(12)": ("parenthesised_negative", "-12.000000", 0), "( 0.00 )": ("negative_zero", "0.000000", 2), "– 7": ("minus_negative", "-7.000000", 0), "−0": ("negative_zero", "0.000000", 0), "--": ("dash_nil", None, None),
        "#n/a": ("spreadsheet_error", None, None), "31/12/2024": ("text", None, None), "12%": ("percentage", "12.000000", 0), "(1.5)%": ("percentage", "-1.500000", 1), "(1.5%)": ("percentage", "-1.500000", 1), "(1.5%": ("unresolved", None, None), ">= 5": ("comparison_bound", None, None), "≤(5)": ("comparison_bound", None, None), "1.2.3": ("unresolved", None, None), "Note 4": ("text", None, None), "": ("text", None, None), "12 34": ("unresolved", None, None),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None])], "i int, t string").orderBy("i")
    got = df.select(records.printed_class("t"), records.printed_number("t").cast("string"), records.printed_decimals("t")).collect()
    assert list(map(tuple, got)) == [*cases.values(), ("text", None, None)]


def test_listing_buckets(spark):
    bodies = ['{"infoQuarterlyData":[{"id":2},{"id":3}],"infoAnnualData":[{"id":1}],"infoWebLink":null,"reqFinancial":[1],"zNew":[],"aNew":[{}],"x":1}', '{"infoAnnualData":{}}', '{"other":[]}', "[]", "{", '{"infoOtherData":[]}', None]
    entries, read = listings.listing_buckets(spark.createDataFrame(list(enumerate(bodies)), "i int, b string"), "b")
    assert rows(entries, "i", "bucket", "pos", F.to_json("item")) == [(0, "annual", 0, '{"id":1}'), (0, "quarterly", 0, '{"id":2}'), (0, "quarterly", 1, '{"id":3}')]
    assert [(r["failure"], r["unrecognised"]) for r in read.orderBy("i").collect()] == [(None, ["aNew", "zNew"]), ("unexpected_schema", []), ("unexpected_schema", []), ("unexpected_schema", []), ("non_json", []), (None, []), ("non_json", [])]


def test_content_verdicts(spark):
    import hashlib

    from tracewell.sources import bodies

    pdf = b"junk%PDF-1.4 " + b"x" * 3000 + b"%%EOF\n"
    tag = lambda b: f'"{hashlib.md5(b).hexdigest()}"'
    cases = [
        (pdf, "pdf", str(len(pdf)), tag(pdf), "valid"), (pdf, "pdf", "9999", None, "truncated"), (pdf, "pdf", "5", None, "length_mismatch"), (pdf, "pdf", "many", 'W/"x"', "valid"), (pdf, "pdf", None, tag(b"other"), "etag_mismatch"), (b"", "pdf", None, None, "empty_body"), (None, "zip", None, None, "empty_body"),
        (b"x" * 1100 + pdf, "pdf", None, None, "not_pdf"), (b"x" * 1019 + pdf[4:], "pdf", None, None, "valid"), (pdf[:-6], "pdf", None, None, "truncated_or_malformed"), (b"PK\x03\x04rest", "zip", None, None, "valid"), (pdf, "zip", None, None, "not_expected_type"), (pdf, "doc", None, None, "unknown_kind"), (b"\x02%PDF-" + b"%%EOF", "pdf", None, None, "valid"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, data binary, kind string, n string, tag string, want string").orderBy("i")
    assert [(i, r[0], r[1]) for i, r in enumerate(df.select(bodies.content_verdict("data", "kind", "n", "tag"), "want").collect()) if r[0] != r[1]] == []


def test_nearest_one_to_one(spark):
    left = spark.createDataFrame([(1, "a", 10.0), (1, "b", 12.0), (1, "c", 50.0), (1, "z", None), (2, "a", 5.0)], "g int, l string, x double")
    right = spark.createDataFrame([(1, 1, 11.5), (1, 2, 9.0), (1, 3, 80.0), (2, 4, 4.0), (2, 5, 6.0), (3, 6, 1.0)], "g int, r int, x double")
    got = ranges.nearest_one_to_one(left, right, "g", "l", "r", "x", 20.0)
    assert rows(got) == [(1, "a", 2, 1.0), (1, "b", 1, 0.5), (2, "a", 4, 1.0)]
    assert rows(ranges.nearest_one_to_one(left, right, "g", "l", "r", "x", 20.0, 0.1)) == [(1, "a", 2, 1.0), (1, "b", 1, 0.5)]
    assert ranges.nearest_one_to_one(left.limit(0), right, "g", "l", "r", "x", 20.0).count() == 0


def test_changed_readings_carry_state_over_triggers(spark, tmp_path):
    schema = "k int, n int, v string"
    src = f"{tmp_path}/in"
    for part in ([(1, 1, "a"), (1, 3, "b"), (1, 2, "a"), (2, 1, "x")], [(1, 5, "b"), (1, 2, "z"), (1, 4, "c"), (2, 2, "x"), (3, 1, "q")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = capture.changed_readings(capture.read_events(spark, src, spark.read.schema(schema).parquet(src).schema, 10), "k", "n", "v")
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "k", "n", "v", "late") == [(1, 2, "z", True), (1, 3, "b", False), (1, 4, "c", False), (1, 5, "b", False)]
