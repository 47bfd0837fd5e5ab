"""Text operators: exact token counts, whole packings, exact mixtures, held-out language accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import langid, mixing, packing, tokens

DATA = "/root/testdata/sf0.001"


# -- tokens -----------------------------------------------------------------------------------
def test_counts_equal_whole_encoding(spark):
    counter = tokens.TokenCounter(tokens.tokenizer_path())
    rnd = random.Random(5)
    parts = [" ", "  ", "   ", "    ", "\n", "\n\n", "\n\n\n", "\t", "a", "The board", "it's", "12,345", "(1.5)", "é", "රු.", "தமிழ்", "-", " \n", "\n ", " ", "\x01", "😀", "'s", "A" * 300]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 12)))
        assert counter.count(t) == counter.whole(t), repr(t)
    for row in spark.read.parquet(f"{DATA}/documents.parquet").limit(60).collect():
        assert counter.count(row["text"]) == counter.whole(row["text"])


def test_counts_of_nothing(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "two words", "s")], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.with_token_counts(df).collect()}
    assert got[1] == got[2] == 0 and got[3] > 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    assert tokens.TokenCounter(tokens.tokenizer_path(name)).count("The board of directors.") > 3


# -- packing ----------------------------------------------------------------------------------
def test_hilbert_curve_is_a_walk_through_all_cells():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def _check(places, packed, capacities):
    size = {}
    for d, n, _ in places:
        size.setdefault(d, []).append(n)
    for plan, cap in capacities.items():
        mine = [r for r in packed if r["plan_id"] == plan]
        used, pieces = {}, {}
        for r in mine:
            used[r["container_id"]] = used.get(r["container_id"], 0) + r["token_to"] - r["token_from"]
            pieces.setdefault(r["doc_id"], []).append((r["token_from"], r["token_to"]))
        assert max(used.values()) <= cap and pieces.keys() == size.keys()
        for d, sizes in size.items():
            assert sum(b - a for a, b in pieces[d]) == sum(sizes)
            if max(sizes) <= cap:
                assert len(pieces[d]) == len(sizes)
            elif len(sizes) == 1:
                p = sorted(pieces[d])
                assert p[0][0] == 0 and all(x[1] == y[0] for x, y in zip(p, p[1:])) and p[-1][1] == sizes[0] and len(p) == -(-sizes[0] // cap)
        assert len({(r["container_id"], r["slot"]) for r in mine}) == len(mine)
        yield sum(used.values()) / (len(used) * cap)


def test_packing_keeps_everything_and_fills(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 4000)
    rnd = random.Random(2)
    # A third of the documents are copies: same place on the curve, other ids.
    places = [(i, rnd.choice([0, 1, 7, 60, 200, 400, 511, 512, 513, 3000]), 5 if i % 3 == 0 else rnd.randrange(2**48)) for i in range(6000)] + [(1, 512, 9), (1, 512, 9)]
    df = spark.createDataFrame(places, "doc_id long, n_tokens long, curve_key long").withColumn("plan_id", F.lit("clash"))
    plans = spark.createDataFrame([(1, 512), (1, 600), (2, 2048), (3, None), (4, 0), (None, 512)], "plan_id int, capacity_tokens int")
    packed = packing.pack_along_curve(df, plans)
    rows = packed.collect()
    assert {r["plan_id"] for r in rows} == {1, 2}
    assert min(_check(places, rows, {1: 512, 2: 2048})) > 0.95
    report = {r["plan_id"]: r for r in packing.fill_report(packed, plans).collect()}
    assert report[1]["n_pieces"] == sum(r["plan_id"] == 1 for r in rows)
    assert packing.pack_along_curve(df.limit(0), plans).count() == 0
    assert packing.pack_along_curve(df, plans.limit(0)).count() == 0


def _likeness(vectors, containers):
    """Mean cosine of pairs of documents within a container."""
    out = []
    for m in containers:
        if len(m) > 1:
            v = vectors[m]
            out.append((v.sum(0) @ v.sum(0) - (v * v).sum()) / (len(m) * (len(m) - 1)))
    return np.mean(out)


def test_containers_hold_neighbours(spark):
    """Documents that share a container are more alike than under a random order, at equal fill."""
    documents = spark.read.parquet(f"{DATA}/../sf0.1/documents.parquet")
    places, plans = packing.curve_places(documents), spark.createDataFrame([(1, 2048)], "plan_id int, capacity_tokens int")
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    row = {d: i for i, d in enumerate(texts)}
    words = [set(t.lower().split()) for t in texts.values()]
    seen = {}
    for ws in words:
        for w in ws:
            seen[w] = seen.get(w, 0) + 1
    vectors = np.zeros((len(words), 4096), np.float32)
    for i, ws in enumerate(words):
        for w in ws:
            vectors[i, hash(w) % 4096] += np.log(len(words) / seen[w])
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)
    got, fill = {}, {}
    for name, p in (("curve", places), ("random", places.withColumn("curve_key", F.xxhash64("doc_id")))):
        packed = packing.pack_along_curve(p, plans)
        held = {}
        for r in packed.collect():
            held.setdefault(r["container_id"], []).append(row[r["doc_id"]])
        got[name], fill[name] = _likeness(vectors, held.values()), packing.fill_report(packed, plans).first()["fill"]
    assert got["curve"] > 1.8 * got["random"] and fill["curve"] > 0.998 and abs(fill["curve"] - fill["random"]) < 0.001


def test_places_of_edge_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 50_000), (4, "word " * 50_000), (5, "\n\t ")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in packing.curve_places(df).collect()}
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == 0 and got[3]["curve_key"] == got[4]["curve_key"] and got[3]["n_tokens"] >= 50_000


# -- mixing -----------------------------------------------------------------------------------
def test_mixture_shares_and_caps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 2000)
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 9000)
    rnd = random.Random(8)
    data = [(i, rnd.choice(["big"] * 6 + ["Small One", "small_one ", "tiny", None, "other", "TINY"]), rnd.randrange(0, 60)) for i in range(9000)]
    sizes = spark.createDataFrame(data, "doc_id long, source string, n_tokens long").withColumn("_block", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small_one", 0.3, 2), ("tiny", 0.2, 3), ("absent", 0.0, 5)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix_sources(sizes, targets)
    rows = mixed.collect()
    report = {r["source"]: r for r in mixing.share_report(mixed, targets).collect()}
    total = sum(r["n_tokens"] for r in rows)
    for source, share, cap in (("big", 0.5, 1), ("small_one", 0.3, 2), ("tiny", 0.2, 3)):
        assert abs(report[source]["n_tokens"] - share * total) <= 200 and report[source]["most_uses"] <= cap
    assert report["absent"]["n_tokens"] == 0
    # No use of a document twice in one pass; at least one source is used up.
    assert len({(r["doc_id"], r["repeat_no"]) for r in rows}) == len(rows)
    have = {}
    for i, s, n in data:
        k = (s or "").lower().strip().replace(" ", "_")
        have[k] = have.get(k, 0) + n
    assert any(abs(report[s]["n_tokens"] - c * have[s]) <= 60 for s, c in (("big", 1), ("small_one", 2), ("tiny", 3)))
    # Positions run through every shard, and shards hold equal numbers of blocks.
    shards = {}
    for r in rows:
        shards.setdefault(r["shard_no"], []).append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in shards.values()) and len(shards) > 10
    again = mixing.mix_sources(sizes.repartition(7), targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_mixture_edges(spark):
    sizes = spark.createDataFrame([(1, "a", 0), (2, None, 5), (3, "b", 0)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    assert mixing.mix_sources(sizes, targets).count() == 0
    assert mixing.mix_sources(sizes.limit(0), targets).count() == 0
    assert mixing.mix_sources(sizes, targets.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a", 10), (1, "a", 10)], "doc_id long, source string, n_tokens long")
    assert sum(r["n_tokens"] for r in mixing.mix_sources(one, targets).collect()) == 20


def test_targets_of_one_source_in_two_spellings(spark):
    sizes = spark.createDataFrame([(i, ["news", "News ", "NE-WS", "web"][i % 4], 10) for i in range(400)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("news", 0.25, 1), ("News ", 0.25, 3), ("web", 0.5, 2), ("web", 0.5, 2), (" ", 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix_sources(sizes, targets)
    report = {r["source"]: r for r in mixing.share_report(mixed, targets, sizes).collect()}
    assert mixed.groupBy("doc_id", "repeat_no").count().where("count > 1").count() == 0
    assert report["News "]["n_tokens"] == report["web"]["n_tokens"] == 2000 and report["News "]["most_uses"] == 1 and report["web"]["most_uses"] == 2
    assert report["News "]["unused_tokens"] == 1000 and report["web"]["unused_tokens"] == 0


def test_a_given_total_leaves_capped_sources_under_their_share(spark):
    sizes = spark.createDataFrame([(i, "small" if i < 50 else "large", 10) for i in range(1000)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("small", 0.5, 3), ("large", 0.5, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix_sources(sizes, targets, total_tokens=10_000)
    report = {r["source"]: r for r in mixing.share_report(mixed, targets, sizes).collect()}
    assert (report["small"]["n_tokens"], report["small"]["most_uses"]) == (1500, 3) and report["large"]["n_tokens"] == 5000
    assert report["small"]["actual_share"] == round(1500 / 6500, 6) and report["large"]["unused_tokens"] == 4500


def test_blocks_grow_with_the_total(spark, monkeypatch):
    """A draw takes fewer than 10^9 blocks; the number of blocks is bounded whatever the total is."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 10)
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 16)
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 500)
    drawn = []
    tree = mixing.SplittingTree
    monkeypatch.setattr(mixing, "_sharder", lambda blocks, shards, seed: drawn.append(blocks) or (lambda s, r: F.lit(0)))
    sizes = spark.createDataFrame([(i, "ab"[i % 2], 10) for i in range(1000)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix_sources(sizes, targets)
    assert sum(drawn[0]) <= 16 + 2 and mixed.count() == 1000
    assert tree([1 << 27, 1 << 27], 4, 1).shards_of(np.zeros(3, int), np.array([0, 1 << 20, (1 << 27) - 1])).shape == (3,)


def test_splitting_tree_gives_exact_disjoint_quotas():
    blocks = [40, 7, 0, 113]
    tree = mixing.SplittingTree(blocks, 9, 3)
    source, rank = np.repeat(np.arange(4), blocks), np.concatenate([np.arange(n) for n in blocks])
    shard = tree.shards_of(source, rank)
    assert set(np.bincount(shard, minlength=9)) == {17, 18}
    # Any part of the blocks, in any order, is routed the same.
    some = np.random.default_rng(1).permutation(160)[:90]
    assert (mixing.SplittingTree(blocks, 9, 3).shards_of(source[some], rank[some]) == shard[some]).all()
    # The share of the large source in a shard varies around its share of all blocks, as a random draw does.
    means = [(mixing.SplittingTree([50, 50], 4, seed).shards_of(np.zeros(50, int), np.arange(50)) == 0).mean() for seed in range(40)]
    assert 0.2 < np.mean(means) < 0.3 and np.std(means) > 0.01


# -- language ---------------------------------------------------------------------------------
def test_codewords_are_apart():
    c = langid.codewords(9)
    assert min(int((c[i] != c[j]).sum()) for i in range(9) for j in range(i)) >= 5
    for n in (2, 3, 40, 100):
        c = langid.codewords(n)
        assert c.shape[0] == n and min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i)) >= langid.LEAST_APART and (np.abs(c.sum(0)) < n).all()
    assert langid.codewords(1).shape == (1, 1)


def test_one_and_two_languages():
    en, de = "the directors have approved the accounts", "die Prüfer haben den Abschluss ohne Einschränkung bestätigt"
    one = langid.LanguageCodes.fit([("en", en)])
    assert one.languages == ["en"] and one.score([en, de])[1].argmax(1).tolist() == [0, 0]
    two = langid.LanguageCodes.fit([("en", en), ("de", de), ("nl", "12 345")])
    assert [two.languages[k] for k in two.score([en, de])[1].argmax(1)] == ["en", "de"]
    with pytest.raises(ValueError, match="no sample"):
        langid.LanguageCodes.fit([("en", "7")])


def test_a_line_has_the_language_of_most_of_its_words(spark):
    model, _ = _model(spark)
    # Words of another script have by far the largest margins, and are fewer.
    line = "The directors expect higher fuel costs to ease only slowly கணக்குகள் கடந்த ஆண்டின்"
    assert model.languages[model.score([line])[1].argmax(1)[0]] == "en"


def test_a_language_nobody_taught_is_unknown(spark):
    samples, documents = spark.read.parquet(f"{DATA}/language_samples.parquet").where("lang <> 'fr'"), spark.read.parquet(f"{DATA}/../sf0.01/documents.parquet").where("coalesce(lang, '') <> 'fr'")
    model = langid.refit_codes(langid.fit_codes(samples, "lang", "sample_text"), samples, documents)
    text = "\n".join(["Les administrateurs ont examiné les comptes de la société et ont approuvé le versement du dividende aux actionnaires."] * 3)
    got = langid.language_stretches(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [(r["first_line"], r["last_line"], r["lang"]) for r in got] == [(1, 3, langid.UNKNOWN)]


def _model(spark):
    samples, documents = spark.read.parquet(f"{DATA}/language_samples.parquet"), spark.read.parquet(f"{DATA}/../sf0.01/documents.parquet")
    return langid.refit_codes(langid.fit_codes(samples, "lang", "sample_text"), samples, documents), samples


# Function words that tell the languages apart, as a judge that shares nothing with the classifiers.
FUNCTION_WORDS = {
    "en": "the of and to which were with for", "de": "der die das und nicht mit auf wird zur", "nl": "het een van dat wordt zal voor niet", "fr": "le les des et une est sur pour", "es": "el los las una por del y se",
    "pt": "o os uma do da não com ao", "id": "yang dan pada dengan untuk tidak dari akan",
}


def _judge(text):
    words = text.lower().split()
    script = sum("\u0b80" <= c <= "\u0bff" for c in text) - sum("\u0d80" <= c <= "\u0dff" for c in text)
    if abs(script) > 0.4 * len(text):
        return "ta" if script > 0 else "si"
    n = sorted(((sum(words.count(w) for w in ws.split()), k) for k, ws in FUNCTION_WORDS.items()), reverse=True)
    return n[0][1] if n[0][0] >= 4 and n[0][0] >= 2 * n[1][0] else None


def test_documents_against_function_words(spark):
    """Documents of one stretch that no fit has seen: the language is that of the function words."""
    model, _ = _model(spark)
    held = spark.read.parquet(f"{DATA}/../sf0.1/documents.parquet").where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0)
    found = langid.document_languages(langid.language_stretches(held, model)).where("n_stretches = 1").join(held.select("doc_id", "text"), "doc_id").collect()
    judged = [(r["lang"], w) for r in found if (w := _judge(r["text"]))]
    assert len(judged) > 900 and {w for _, w in judged} == set(langid.LABELS)
    assert sum(a == b for a, b in judged) / len(judged) > 0.99


def test_held_out_samples(spark):
    samples, documents = spark.read.parquet(f"{DATA}/language_samples.parquet"), spark.read.parquet(f"{DATA}/../sf0.01/documents.parquet")
    fit = samples.where("sample_id % 2 = 0")
    model = langid.refit_codes(langid.fit_codes(fit, "lang", "sample_text"), fit, documents)
    rest = samples.where("sample_id % 2 = 1").collect()
    number = model.score([r["sample_text"] for r in rest])[1].argmax(1)
    assert np.mean([model.languages[k] == r["lang"] for k, r in zip(number, rest)]) > 0.95


def test_stretches_of_mixed_and_edge_texts(spark):
    model, _ = _model(spark)
    en, de, ta = "The directors expect higher fuel costs to ease only slowly.", "Die Prüfer weisen ohne Einschränkung auf den Verkauf des alten Werks hin.", "கணக்குகள் கடந்த ஆண்டின் கொள்கைகளுக்கு அமையவே தயாரிக்கப்பட்டுள்ளன."
    texts = [f"12 345\n{en}\n\n- 7\n{en}\n{de}\n{ta}", "", None, "12 - 14\n---", "\n".join([en] * 3000), f"{de}\n" * 2]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, first_line string")
    got = sorted((r["doc_id"], r["first_line"], r["last_line"], r["lang"]) for r in langid.language_stretches(df, model).collect())
    assert got == [(0, 2, 5, "en"), (0, 6, 6, "de"), (0, 7, 7, "ta"), (4, 1, 3000, "en"), (5, 1, 2, "de")]
    assert langid.language_stretches(df.limit(0), model).count() == 0
    sure = langid.language_stretches(df, model).agg(F.min("confidence"), F.max("confidence")).first()
    assert 0 < sure[0] <= sure[1] <= 1


def test_labels(spark):
    names = ["en", "EN-lk", "en_GB", " English ", "sin", "Sinhala", "xx", "", None, "und", "ger", "Tamil"]
    got = [r[0] for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i").select(langid.iso_label(F.col("n"))).collect()]
    assert got == ["en", "en", "en", "en", "si", "si", None, None, None, None, "de", "ta"]
    own = spark.createDataFrame([(i, n) for i, n in enumerate(["xx", "PL", "Polish", "english"])], "i int, n string").orderBy("i")
    assert [r[0] for r in own.select(langid.iso_label(F.col("n"), ["xx"], {"pl": ["polish"]})).collect()] == ["xx", "pl", "pl", None]


def test_bounded_sample_has_every_language(spark, monkeypatch):
    data = [("de", f"d{i}") for i in range(50)] + [("si", "s0"), ("si", "s1"), ("ta", "t0"), (None, "x"), ("ta", None)]
    df = spark.createDataFrame(data, "lang string, sample_text string").repartition(3)
    assert langid._sampled(df, "lang", "sample_text") == sorted((a, b) for a, b in data if a and b)
    monkeypatch.setattr(langid, "MAX_SAMPLES", 5)
    got = langid._sampled(df, "lang", "sample_text")
    assert len(got) == 5 and {("si", "s0"), ("si", "s1"), ("ta", "t0")} < set(got) and got == sorted(got)


def test_checks_hold_on_the_small_tables(spark):
    import duckdb

    from tracewell.llm import registry

    c = duckdb.connect()
    for t in ("documents", "container_plans", "mixture_targets"):
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/../sf0.01/{t}.parquet')")
    for name in ("p8_checks", "p9_checks"):
        got = registry.QUERIES[name](spark, f"{DATA}/../sf0.01")
        assert sorted(map(tuple, got.collect())) == sorted(c.execute(f"select {', '.join(got.columns)} from ({registry.SQL[name]})").fetchall())
