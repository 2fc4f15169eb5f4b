"""Spelling variants, collocations and toxicity against brute force, SQL and held-out labels."""

import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.llm import collocations, queries, toxicity, variants
from terraloom.llm.common import crc_mod

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n", None, "a", "That it.", "x" * 5000, "É é ́ İ Σ\x1c\x85 日本語 🙂 \x00 nul", "a b c d e " * 400, "Resting besting ×÷ù", "wordless " * 20_000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, null ids and languages, and extra columns whose names clash with those of results."""
    rows = [(i, t, "en", 7, 0.5) for i, t in enumerate(ODD)] + [(8, ODD[8], None, 7, 0.5), (None, "no id here", None, 7, 0.5), (9, ODD[9], "en", 7, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, score double").withColumns({"word": F.lit(1), "phrase": F.lit("x"), "h": F.lit(2), "y": F.lit(3)})


# -- 11: spelling variants


def one_apart(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    few, many = sorted((a, b), key=len)
    return any(many[:i] + many[i + 1 :] == few for i in range(len(many)))


def plain_words(rows) -> dict:
    lower = {c: c + 32 for c in range(65, 91)}
    found: Counter = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate(lower)
            h = crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def plain_variants(words: dict) -> dict:
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * n:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def test_variants_equal_brute_force(spark, docs):
    rows = docs.limit(120).select("doc_id", "text").collect()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: tuple(r)[1:] for r in variants.variants(df).collect()}
    assert got == plain_variants(plain_words(rows)) and any(v[0] for v in got.values())


def test_words_equal_brute_force_on_the_whole_table(docs):
    assert {r["word"]: r["n"] for r in variants.word_counts(docs).collect()} == plain_words(docs.collect())


@given(st.lists(st.text(alphabet="abéÿ", min_size=6, max_size=40), min_size=2, max_size=30), st.integers(0, 10**9))
@settings(max_examples=150, deadline=None)
def test_shard_finds_every_near_word_once(words, seed):
    rng = random.Random(seed)
    words = set(words)
    for w in list(words):  # neighbours of all kinds, at all places
        i = rng.randrange(len(w) + 1)
        words |= {x for x in (w[:i] + "a" + w[i:], w[:i] + w[i + 1 :], w[:i] + "é" + w[i + 1 :]) if len(x) >= 6}
    shard = variants.Shard()
    for w in words:
        shard.add(0, w, w)
        shard.add(1, w, w)
    for w in words:
        assert sorted(x for x, _ in shard.scan(w)) == sorted(x for x in words if one_apart(w, x))


def test_split_segments_and_many_shards_change_nothing(spark, docs, monkeypatch):
    want = sorted(map(tuple, variants.near_words(variants.word_counts(docs)).collect()), key=str)
    monkeypatch.setattr(variants, "SEGMENT_WORDS", 3)
    monkeypatch.setattr(variants, "SHARD_CHARS", 300)
    assert sorted(map(tuple, variants.near_words(variants.word_counts(docs)).collect()), key=str) == want


def test_roots_follow_long_chains_and_ties(spark):
    # Numbers 5, 25, 125, 625 in a chain of one-letter steps; the best near words of "zzaaaaa" tie.
    chain = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("zzaaaaa", 5), ("yzaaaaa", 25), ("xzaaaaa", 25)]
    text = " ".join(" ".join([w] * n) for w, n in chain)
    rows = [(k, text) for k in range(400) if all(crc32(f"{k}:{w}".encode()) % 199 for w, _ in chain)][:1]
    got = {r["word"]: r for r in variants.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got["aaaaaa"]["form"] == "aaaaab" and {got[w]["root"] for w, _ in chain[:4]} == {"aaabbb"}
    assert (got["zzaaaaa"]["form"], got["zzaaaaa"]["n_near"]) == ("xzaaaaa", 2)
    assert got["aaabbb"]["form"] is None and got["aaabbb"]["form_n"] is None


def test_variants_of_odd_tables(spark, odd):
    got = {r["word"]: tuple(r)[1:] for r in variants.variants(odd).collect()}
    assert got == plain_variants(plain_words(odd.collect()))
    assert variants.variants(odd.limit(0)).count() == 0
    long = spark.createDataFrame([(k, f"{'q' * 30_000}{'' if k % 2 else 'r'}") for k in range(12)], "doc_id long, text string")
    assert {r["n_near"] for r in variants.variants(long).collect()} == {1}


# -- 12: collocations


def sql_of(df) -> list[tuple]:
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang").toArrow())
    return sorted(con.execute(queries.oracle_sql()["op12_collocations"]).fetchall())


def test_collocations_equal_sql(spark, docs):
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == sql_of(docs) and got


def test_collocations_of_built_texts(spark):
    rng = random.Random(3)
    texts = [(k, " ".join(rng.choice(["new york city", "new york", "a b", "b a", "la la la", "x", "é"]) + rng.choice(["", ".", "\t", "\r\n", "!"]) for _ in range(40)), rng.choice(["en", None, "fr"])) for k in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(7)
    got = sorted(map(tuple, collocations.collocations(df).collect()))
    assert got == sql_of(df)
    phrases = {g[2] for g in got if g[0] == "und"}
    assert "new york" in phrases and len(got) > 20


def test_blocks_and_bits_change_no_count(spark, docs, monkeypatch):
    want = sorted(map(tuple, collocations.collocations(docs).collect()))
    monkeypatch.setattr(collocations, "HELD_BYTES", 300)
    monkeypatch.setattr(collocations, "HELD_CHARS", 500)
    monkeypatch.setattr(collocations, "BITS", 1 << 18)  # most rare phrases pass
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want


def test_scores_pass_64_bits(spark):
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    words = spark.createDataFrame([("en", "a", 10**12), ("en", "b", 3 * 10**11)], "lang string, phrase string, a long")
    pairs = spark.createDataFrame([("en", "a b", 2 * 10**11 + 7)], "lang string, phrase string, a long")
    (row,) = collocations.scored(totals, words, pairs, 10).collect()
    assert row["score"] == 1000 * (2 * 10**11 + 7) * 10**13 // (10**12 * 3 * 10**11)


def test_best_of_each_language(spark):
    """Only so many of each language are returned, in order, ties by a and by the phrase."""
    n = 90
    totals = spark.createDataFrame([("en", 10**6), ("fr", 10**6)], "lang string, n long")
    words = spark.createDataFrame([(g, f"w{k}", 100 + k % 3) for g in ("en", "fr") for k in range(n)], "lang string, phrase string, a long")
    pairs = spark.createDataFrame([(g, f"w{k} w{(k * 7 + 1) % n}", 100) for g in ("en", "fr") for k in range(n)], "lang string, phrase string, a long")
    got = collocations.scored(totals, words, pairs, 20).collect()
    for g in ("en", "fr"):
        rows = [(100 + k % 3, 100 + (k * 7 + 1) % n % 3, f"w{k} w{(k * 7 + 1) % n}") for k in range(n)]
        want = sorted((-(1000 * 100 * 10**6 // (left * r)), p) for left, r, p in rows)[:20]
        assert [(-r["score"], r["phrase"]) for r in sorted(got, key=lambda r: r["rank"]) if r["lang"] == g] == want


def test_collocations_of_odd_tables(spark, odd):
    got = sorted(map(tuple, collocations.collocations(odd).collect()))
    assert got == sql_of(odd) and {g[0] for g in got} >= {"en", "und"}
    assert collocations.collocations(odd.limit(0)).count() == 0


# -- 13: toxicity


def labelled(spark, n=600, seed=1):
    """Texts of random words; a quarter of them holds one of four rare words, in all places."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "an", "ve", "shu", "pol"]
    rows = []
    for k in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 200))]
        bad = k % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words) + 1), rng.choice(["grumbix", "Fnordly", "ZOTZEN", "quibbet"]))
        rows.append((k, " ".join(words), int(bad)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"), {k: y for k, _, y in rows}


def test_toxicity_held_out(spark):
    docs, labels, truth = labelled(spark)
    got = toxicity.classify(docs, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 600 and len(held) > 80
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("toxic", F.when(crc_mod("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    both = [sorted(map(tuple, toxicity.classify(docs, x).collect())) for x in (labels, flipped)]
    assert both[0] == both[1]


def test_toxicity_equals_plain_fit(spark):
    """The same model from dictionaries of n-grams and dense gradient steps."""
    docs, labels, truth = labelled(spark, 240, seed=5)
    model = toxicity.fit(docs, labels)
    sets = {r["doc_id"]: set(toxicity.grams(r["text"]).tolist()) for r in docs.collect()}
    n_pos = sum(truth.values())
    n_neg = len(truth) - n_pos
    pos, neg = Counter(), Counter()
    for k, s in sets.items():
        (pos if truth[k] else neg).update(s)
    ratio = {}
    for g in pos.keys() | neg.keys():
        r = np.log((pos[g] + 1) / (n_pos + 2)) - np.log((neg[g] + 1) / (n_neg + 2))
        if pos[g] + neg[g] >= toxicity.SEEN and abs(r) >= toxicity.RATIO:
            ratio[g] = r
    keys = sorted(ratio, key=lambda g: (-abs(ratio[g]) * np.sqrt(pos[g] + neg[g]), np.uint64(g).astype(np.int64)))[: toxicity.FEATURES]
    keys = sorted(keys)
    assert keys == model.keys.tolist()
    x = np.array([[ratio[g] * (g in sets[k]) for g in keys] for k in sorted(sets)])
    y = np.array([truth[k] for k in sorted(sets)], float)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        p = 1 / (1 + np.exp(-z))
        return float((np.logaddexp(0, z) - y * z).mean() + toxicity.RIDGE / 2 * w[:-1] @ w[:-1]), np.append(x.T @ (p - y) / len(y) + toxicity.RIDGE * w[:-1], (p - y).mean())

    w = toxicity.minimise(loss, len(keys) + 1)
    assert np.abs(loss(w)[1]).max() < 1e-3
    r = np.array([ratio[g] for g in keys])
    assert np.allclose(w[:-1] * r, model.weight, atol=1e-3) and abs(w[-1] - model.bias) < 1e-3
    score = model.scorer()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert np.allclose([score(texts[k]) for k in sorted(texts)], 1 / (1 + np.exp(-(x @ (model.weight / r) + model.bias))))


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    text = "Ünd \t das 🙂 ist ein langer Text. " * 30
    want = toxicity.grams(text)
    monkeypatch.setattr(toxicity, "_BLOCK", 17)
    assert np.array_equal(toxicity.grams(text), want)
    plain = {(k, w) for k in toxicity.SIZES for t in [f" {text.lower()} ".replace("\t", " ")] for w in (t[i : i + k] for i in range(len(t) - k + 1))}
    assert len(want) == len(plain)


def test_the_sample_is_bounded_by_rows(spark):
    """Many rows of one labelled id count once for each text, and the bound holds for different texts of one id."""
    same = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    many = spark.range(3000).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "doc_id long, toxic int")
    assert toxicity.sample(same, labels, 100).count() == 1
    assert 40 < toxicity.sample(same.union(many), labels, 100).count() < 200


def test_toxicity_of_odd_tables(spark, odd):
    labels = spark.createDataFrame([(0, 0), (5, 1), (5, 0), (6, None), (None, 1), (8, 1)], "doc_id long, toxic int").withColumn("score", F.lit(1))
    got = toxicity.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(r["score"] is not None for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert {r["score"] for r in toxicity.classify(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(odd.limit(0), labels).count() == 0
