"""The training-data operators against the libraries, brute force, round trips and held-out accuracy."""

import random
import re
import time
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraloom.llm import ann, bpe, html_wrapper, langid, lm_score, near_dedup, packing, quality, queries, token_count, winnow

SF = "/root/testdata/sf0.001"
WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", None, "a", "That it.", "x" * 5000, "é ́ İ Σ ΑΣ \x1c \x85  日本語 🙂 <|endoftext|> 's", "▁a  b ", "12 34 !!! ***", "a b c d e " * 400]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a repeated row, null ids, and extra columns whose names clash with those of results."""
    rows = [(i, t, "en", 7, 0.5) for i, t in enumerate(ODD)] + [(4, ODD[4], "en", 7, 0.5), (None, "no id here", None, 7, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int, score double").withColumn("range", F.lit(1)).withColumn("root", F.lit("x"))


# -- 6: BPE


@pytest.fixture(scope="module")
def coder():
    return bpe.BacktrackingBpe(bpe.vocabulary_text(WORDS)), Tokenizer.from_file(WORDS)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_the_library(coder, text):
    ours, lib = coder
    ids = lib.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_on_runs_and_specials(coder):
    ours, lib = coder
    rng = random.Random(1)
    parts = ["a", "aa", "th", "the", "'s", "<|endoftext|>", "<|", "Σ", " ", "\n", "1", "é", "é", "İ", "!"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert ours.encode(text) == lib.encode(text, add_special_tokens=False).ids, text


def test_bpe_knows_every_character(coder):
    ours, lib = coder
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c} " for c in chars[k : k + 50]) for k in range(0, len(chars), 50)]
    for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        assert ours.encode(t) == e.ids


def test_bpe_query(spark, docs, odd, coder):
    _, lib = coder
    for table in (docs, odd):
        got = {r["doc_id"]: tuple(r)[1:] for r in bpe.encode_decode_digests(table, WORDS).collect()}
        for r in table.collect():
            ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
            back = lib.decode(ids, skip_special_tokens=False)
            assert got[r["doc_id"]] == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(back.encode()).hexdigest())
    assert bpe.encode_decode(odd.limit(0), WORDS).count() == 0
    row = bpe.encode_decode(odd.where("doc_id = 5"), WORDS).first()
    assert row["ids"] == lib.encode("That it.", add_special_tokens=False).ids


def test_bpe_query_on_separators(spark, coder):
    """Python takes U+001C to U+001F for white space, the library does not."""
    _, lib = coder
    texts = ["\x1c", " \x1f\n", "\x1d\x1e", " \n\t "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encode_decode_digests(df, WORDS).collect():
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())


# -- 5: token counts


def test_counts_equal_the_library(spark, docs, odd):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table in (docs, odd):
        got = {r["doc_id"]: r for r in token_count.count_tokens(table, PIECES).collect()}
        for r in table.collect():
            n, g = len(lib.encode(r["text"] or "")), got[r["doc_id"]]
            assert (g["n_bytes"], g["n_tokens"], g["over_limit"]) == (len((r["text"] or "").encode()), n, n > 4096)
    assert token_count.count_tokens(odd.limit(0), PIECES).count() == 0


def test_whole_tokens_are_proven():
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    c = token_count.Counter(token_count.read_pieces(PIECES))
    marked = sorted(p for p in c.whole if p.startswith("▁") and len(p) > 1 and p[1] != "▁")[::37]
    assert all(len(lib.encode(p[1:])) == 1 for p in marked)


@given(st.text(alphabet=st.sampled_from(list("abthe \n▁é日.<s>")), max_size=80))
@settings(max_examples=300, deadline=None)
def test_counts_on_random_texts(text):
    lib, c = _counter()
    assert c.count(text) == len(lib.encode(text))


_CACHE: list = []


def _counter():
    if not _CACHE:
        _CACHE.append((sentencepiece.SentencePieceProcessor(model_file=PIECES), token_count.Counter(token_count.read_pieces(PIECES))))
    return _CACHE[0]


# -- 2: packing


def _check_packing(rows, texts, lib, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array([*lib.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sum(r["length"] for r in rows) / (capacity * len(by_seq))


def test_packing(spark, docs, odd, coder):
    _, lib = coder
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fill = [_check_packing(packing.pack(docs.repartition(parts), WORDS).collect(), texts, lib, 2048) for parts in (1, 40)]
    assert min(fill) > 0.97 and abs(fill[0] - fill[1]) < 0.011
    some = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    _check_packing(packing.pack(some, WORDS, capacity=64, windows=4).collect(), {r["doc_id"]: r["text"] for r in some.collect()}, lib, 64)
    assert packing.pack(odd.limit(0), WORDS).count() == 0
    assert packing.pack(odd, WORDS).where("doc_id = 4").count() == 2


@given(st.lists(st.integers(1, 99), min_size=1, max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_differencing_is_a_partition(sizes, k):
    parts = packing.differencing(sizes, k)
    assert len(parts) == k and sorted(i for p in parts for i in p) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= max(sizes)


def test_the_window_count_rises_with_an_exceeded_capacity():
    # Three pieces of 3 need three windows of 5, though two could hold as many tokens.
    assert sorted(map(sorted, packing.pack_group([3, 3, 3], 5))) == [[0], [1], [2]]
    rng, rose = random.Random(3), 0
    for _ in range(60):
        sizes = [rng.randint(1, 384) for _ in range(rng.randint(1, 120))]
        found = packing.pack_group(sizes, 2048)
        assert sorted(i for w in found for i in w) == list(range(len(sizes))) and all(sum(sizes[i] for i in w) <= 2048 for w in found)
        rose += len(found) > -(-sum(sizes) // 2048)
    assert 0 < rose < 40


def test_the_subsets_are_the_windows(spark, docs, monkeypatch):
    """With a plainer partition in place of differencing more windows are needed: nothing else evens them out."""
    rows = packing.pack(docs.coalesce(1), WORDS).collect()
    sizes = [r["length"] for r in rows if r["length"] < 2048]
    few = len(packing.pack_group(sizes))
    assert len({r["sequence_id"] for r in rows}) <= few + sum(r["length"] == 2048 for r in rows)
    monkeypatch.setattr(packing, "differencing", lambda sizes, k: [list(range(j, len(sizes), k)) for j in range(k)])
    assert len(packing.pack_group(sizes)) > few + 5


def test_marks_behind_every_letter(spark, coder):
    """A lowered letter may end in a mark that joins the punctuation behind it."""
    _, lib = coder
    letters = [chr(c) for c in range(0x80, 0x20000) if chr(c).isalpha()]
    chunks = [f"a{c}{m}" for c in letters for m in (".,;:!?" if ord(c) < 0x3000 else ".")] + ["YENİ.", "İ!?", "İZMİR,"]
    texts = [" ".join(chunks[k : k + 500]) for k in range(0, len(chunks), 500)]
    coded, edges = packing._encoder(bpe.vocabulary_text(WORDS))(pa.array(texts))
    for k, e in enumerate(lib.encode_batch(texts, add_special_tokens=False)):
        assert coded[edges[k] : edges[k + 1]].tolist() == e.ids


def test_differencing_beats_greedy():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]


# -- 10: winnowing


def _winnow_slow(text, k, w):
    points = [0] * (k - 1) + [ord(c) + 1 for c in text] + [0] * (k - 1)
    h = winnow.gram_hashes(np.array(points, np.uint64), k)
    found = []
    for stop in range(1, len(h) + w):
        own = range(max(0, stop - w), min(stop, len(h)))
        at = max(i for i in own if h[i] == min(h[j] for j in own))
        if not found or found[-1] != at:
            found.append(at)
    return h, found


@given(st.text(alphabet="ab", min_size=1, max_size=120))
@settings(max_examples=100, deadline=None)
def test_winnowing_equals_the_plain_form(text):
    h, found = _winnow_slow(text, 5, 7)
    hashes, where = winnow.winnow(text, 5, 7)
    assert where.tolist() == found and hashes.tolist() == h[found].tolist()


def test_equal_grams_have_equal_hashes():
    text = "the quick brown fox and the quick brown dog"
    h = winnow.gram_hashes(np.frombuffer(text.encode("utf-32-le"), np.uint32), 9)
    assert h[text.index("the quick")] == h[text.rindex("the quick")] and len(set(h.tolist())) > 20


def test_match_guarantee():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for n in range(60):
        shared = word(winnow.K + winnow.W - 1)
        a, b = word(200) + shared + word(100), word(n) + shared + word(5 * n)
        assert len(np.intersect1d(winnow.winnow(a)[0], winnow.winnow(b)[0])) > 0


def test_blocks_do_not_change_the_choice(monkeypatch):
    h = winnow.gram_hashes(np.frombuffer(("abcab" * 400).encode("utf-32-le"), np.uint32), 5)
    whole = winnow.choose(h, 16).tolist()
    monkeypatch.setattr(winnow, "_BLOCK", 100)
    assert winnow.choose(h, 16).tolist() == whole


def test_lengths_make_no_difference():
    """A text and the same text with two characters more have most choices in common, at every length."""
    rng = random.Random(2)
    for n in (5, 8, 22, 23, 24, 31, 32, 100, 191, 192, 3000):
        text = "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
        a, b = (np.unique(winnow.winnow(t)[0]) for t in (text, text + "xy"))
        assert winnow.likeness(a, b) > 0.15, n


def test_short_texts_have_several_choices():
    a, b = (np.unique(winnow.winnow(t)[0]) for t in ("That it.", "That iX!"))
    assert 0 < winnow.likeness(a, b) < 1 and len(winnow.winnow("x")[0]) >= 1


def test_fingerprint_query(spark, docs, odd):
    for table in (docs, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = {r["doc_id"]: r for r in winnow.fingerprint(table).collect()}
        texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
        ids = sorted(texts)
        for i, nxt in zip(ids, ids[1:] + ids[:1]):
            edited = texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[nxt][: len(texts[i]) // 4]
            a, b, c = (winnow.winnow(x) for x in (texts[i], edited, texts[nxt]))
            r = rows[i]
            assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == sha256(edited.encode()).hexdigest()
            assert r["fingerprint"] == winnow.fingerprint_text(*a) and r["edited_fingerprint"] == winnow.fingerprint_text(*b)
            assert r["near_edited"] == winnow.likeness(np.unique(a[0]), np.unique(b[0])) and r["near_next"] == winnow.likeness(np.unique(a[0]), np.unique(c[0]))
    assert winnow.fingerprint(odd.limit(0)).count() == 0
    assert winnow.fingerprint(odd).count() == odd.count()
    one = winnow.fingerprint(odd.where("doc_id = 5")).first()
    assert one["near_next"] == 1.0


def test_fingerprints_of_a_repeated_id(spark, monkeypatch):
    """One id with most of the rows: its rows are in several ranges, and each still meets the row after it."""
    monkeypatch.setattr(winnow, "RANGE_ROWS", 8)
    texts = [(k, f"text number {k} of its own") for k in range(20)] + [(7, f"many rows of one id {k}") for k in range(100)] + [(None, f"no id {k}") for k in range(30)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    rows = winnow.fingerprint(df).collect()
    from collections import Counter as C

    hashed = {(r["id"], r["text"]): r["h"] for r in df.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, hashed[t]))
    want = C((i, sha256(winnow.edited(t, nxt).encode()).hexdigest()) for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]))
    assert C((r["doc_id"], r["edited_sha256"]) for r in rows) == want


# -- 7: language


def _toy(prob):
    return langid.Model(["x", "y"], ["a", "ab", "abbaab", "b", "ba"], np.log(prob))


def _segmentations(word, pieces):
    if not word:
        yield []
    for p in {word[:k] for k in range(1, len(word) + 1)} & set(pieces) | ({word[0]} if word and word[0] not in pieces else set()) if word else ():
        for rest in _segmentations(word[len(p) :], pieces):
            yield [p, *rest]


def test_forward_and_expectations_sum_all_segmentations():
    prob = np.random.default_rng(8).dirichlet(np.ones(6), 2).T
    m = _toy(prob)
    words = ["a", "abab", "bbaab", "abbaabc", "ccba", "abbaababbaab"]
    weight = np.random.default_rng(9).uniform(0, 3, (len(words), 2))
    place = lambda p: m.vocabulary.index(p) if p in m.vocabulary else len(m.vocabulary)
    want, total = np.zeros_like(prob), np.zeros((len(words), 2))
    for k, w in enumerate(words):
        ways = [[place(p) for p in s] for s in _segmentations(w, m.vocabulary)]
        chance = np.array([prob[s].prod(axis=0) for s in ways])
        total[k] = chance.sum(axis=0)
        for s, c in zip(ways, chance):
            for p in s:
                want[p] += c / total[k] * weight[k]
    assert np.allclose(np.exp(m.log_words(words)), total) and np.allclose(m.expected(words, weight), want)
    nxt = langid.improved(m, want, 0.5)
    assert np.allclose(np.exp(nxt.log_p), (want + 0.5) / (want + 0.5).sum(axis=0))


def test_whole_vocabulary_and_long_words():
    vocabulary = langid.read_vocabulary(PIECES)
    assert max(map(len, vocabulary)) == 16 and len(vocabulary) > 20_000
    m = langid.start(["x"], vocabulary)
    long = m.log_words(["ab" * 5000])[0, 0]
    assert long < -20_000 and m.log_words(["ab" * 10_000])[0, 0] == pytest.approx(2 * long, rel=1e-3)


def test_training_equals_one_machine(spark, docs):
    """The distributed rounds give what the same rounds give over all words at once."""
    some = docs.where("lang is not null and text is not null")
    model = langid.train(some, PIECES)
    counts = defaultdict(lambda: np.zeros(len(model.langs)))
    for r in some.collect():
        for w in langid.words_of(r["text"]):
            for s in langid.letters_of(w):
                counts[s][model.langs.index(r["lang"])] += 1
    plain = langid.start(model.langs, model.vocabulary)
    for _ in range(langid.ROUNDS):
        plain = langid.improved(plain, plain.expected(list(counts), np.array(list(counts.values()))))
    assert np.allclose(plain.log_p, model.log_p, atol=1e-6)
    texts = [r["text"] for r in docs.limit(20).collect()]
    pred, score, _ = langid.predictor(model)(texts)
    for t, p, s in zip(texts, pred, score):
        total = sum((plain.log_words([w])[0] for w in langid.words_of(t or "")), np.zeros(len(model.langs)))
        assert p == model.langs[total.argmax()] and s == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-3)


def test_expected_counts_come_in_few_vectors(spark):
    """However many partitions the words lie in, the driver gets a fixed number of vectors."""
    words = [(w, [1.0, 2.0]) for w in ("a", "abab", "bbaab", "abbaabc", "ccba")] * 20
    m = _toy(np.random.default_rng(8).dirichlet(np.ones(6), 2).T)
    counts = spark.createDataFrame(words, "word string, n array<double>").repartition(50)
    assert counts.rdd.getNumPartitions() == 50 and langid._sums(counts, m).count() <= langid.PARTS
    assert np.allclose(langid._expected(counts, m), m.expected([w for w, _ in words], np.array([n for _, n in words])))


def test_language_ties_and_long_texts(spark):
    rows = [(0, "aaa bbb", "p"), (1, "aaa bbb", "q"), (2, "aaa", None), (3, "word " * 200_000, None), (4, "x" * 300_000, None), (5, "1 2 ½", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.predict(df, langid.train(df, PIECES)).collect()}
    assert got[2]["lang_pred"] == "p" and got[2]["score"] == pytest.approx(0.5) and got[5]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_query(spark, docs, odd):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert held and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    got = {r["doc_id"]: r for r in langid.identify(odd, PIECES).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 3, 9)] == ["und"] * 5 and all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(odd.limit(0), PIECES).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string")), PIECES).collect()} == {"und"}


# -- 9: quality


def test_isotonic():
    at, share = quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert at.tolist() == [1, 2.5, 4] and share.tolist() == [0, 0.5, 1]


def test_quality_query(spark, docs, odd):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_quality(spark, sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.classify(odd, none).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(len(ODD))] + [(3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(odd, some).count() == odd.count() and quality.classify(odd.limit(0), some).count() == 0


def test_quality_equals_plain_ridge(spark):
    """Every document's score, worked out in one place: statistics, features, ridge weights, pooled shares."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in queries.op9_quality(spark, sf).collect()}
    crc = lambda i: crc32(str(i).encode())
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    y = {r["doc_id"]: float(r["quality"]) for r in labels.collect() if r["quality"] is not None and r["doc_id"] in text and crc(r["doc_id"]) % 3 != 1}
    assert len(y) < quality.LABELLED
    x = {i: np.array(quality.statistics(t)) for i, t in text.items()}
    known = np.array([x[i] for i in y])
    mean, scale = known.mean(axis=0), np.maximum(known.std(axis=0), 1e-6)
    fitted, held = [i for i in y if crc(i) % 16 >= 4], [i for i in y if crc(i) % 16 < 4]
    features = lambda ids: quality.Model.features(np.array([x[i] for i in ids]), mean, scale)
    f, t = features(fitted), np.array([y[i] for i in fitted])
    # Ridge as least squares with extra rows.
    ridge = np.sqrt(len(fitted) * quality.RIDGE / quality.FEATURES) * np.eye(f.shape[1])
    weight = np.linalg.lstsq(np.vstack([f, ridge]), np.concatenate([t, np.zeros(len(ridge))]), rcond=None)[0]
    raw, target = features(held) @ weight, np.array([y[i] for i in held])
    order = np.argsort(raw)
    # Isotonic regression by its max-min formula.
    sums = np.concatenate([[0.0], np.cumsum(target[order])])
    n = len(order)
    share = [max(min((sums[b] - sums[a]) / (b - a) for b in range(k + 1, n + 1)) for a in range(k + 1)) for k in range(n)]
    blocks = {}
    for r, s in zip(raw[order], share):
        blocks.setdefault(round(s, 12), []).append(r)
    at, value = np.array([np.mean(v) for v in blocks.values()]), np.array(list(blocks))
    want = dict(zip(text, np.interp(features(list(text)) @ weight, at, value)))
    assert max(abs(got[i] - want[i]) for i in text) < 1e-3


def test_quality_sample_shuffles_no_text(spark):
    """Also where Spark does not broadcast by itself, as with larger tables."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
        known = spark.createDataFrame([(i, i % 2 / 1.0) for i in range(0, 400, 2)], "doc_id long, y double")
        some, ids = quality.labelled(df, known, 1.0)
        assert {r["doc_id"] for r in some.collect()} == {r["doc_id"] for r in ids.collect()} == set(range(0, 200, 2))
        assert "Exchange hashpartitioning" not in some._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_quality_of_ties_and_long_texts(spark):
    texts = ["same words here"] * 4 + ["word " * 400_000, "x" * 1_000_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in quality.classify(df, labels).collect()}
    assert len({got[i] for i in range(4)}) == 1 and all(0 <= s <= 1 for s in got.values())


# -- 8: near-duplicates


def brute_classes(texts: dict) -> dict:
    """Classes of all ids by comparing every pair that shares a shingle."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"\w+", t.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {t}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            common.update((j, i) for j in having[x])
            having[x].append(i)
    for (a, b), c in common.items():
        if c >= 0.8 * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def planted():
    """Copies, chains of near copies, and many texts around one passage."""
    rng = random.Random(9)
    word = lambda: "w%d" % rng.randint(0, 5000)
    texts = [" ".join(word() for _ in range(rng.randint(20, 120))) for _ in range(60)]
    for base in list(texts[:12]):
        now = base.split()
        for _ in range(rng.randint(1, 8)):
            now = list(now)
            now[rng.randrange(len(now))] = word()
            texts.append(" ".join(now))
    passage = [word() for _ in range(25)]
    texts += [" ".join(passage + [word() for _ in range(rng.randint(0, 12))]) for _ in range(80)]
    texts += [texts[3]] * 5 + [texts[20].upper() + "!"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_near_duplicates_equal_brute_force(spark, docs):
    cases = planted()
    for texts in (cases, {r["doc_id"]: r["text"] for r in docs.collect()}):
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
        got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
        assert got == brute_classes(texts)


def test_repeated_lines_lose_no_link(spark):
    """Pairs whose sets are alike, while a line of theirs occurs once and 50 times, or twice and 200 times."""
    rng = random.Random(4)
    line = lambda n: [f"r{rng.randint(0, 10**6)}" for _ in range(n)]
    texts = []
    for length, few, many in [(12, 1, 50)] * 40 + [(8, 2, 200)] * 40:
        body, again = line(60), line(length)
        other = body[:-2] + line(1) + body[-1:]
        texts += [" ".join(body + again * few), " ".join(other + again * many)]
    texts = dict(enumerate(texts))
    want = brute_classes(texts)
    assert len(set(want.values())) == 80
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()} == want


def test_near_duplicates_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.execute(queries.oracle_sql()["op8_near_duplicates"])
    assert [d[0] for d in rel.description] == ["doc_id", "class_id", "text_id"]
    assert sorted(rel.fetchall()) == sorted(map(tuple, queries.op8_near_duplicates(spark, SF).collect()))


def test_prefix_pairs_lose_nothing(spark):
    texts = planted()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = near_dedup.prepare(df, 4, 4, "doc_id", "text").select("id", "shingles").cache()
    apart = sets.select("id", F.col("id").alias("class"))
    pairs = {tuple(r) for r in near_dedup.prefix_pairs(sets, apart, 0.8).collect()}
    arrays = {r["id"]: set(near_dedup.unpacked_set(bytes(r["shingles"])).tolist()) for r in sets.collect()}
    want = {(a, b) for a in arrays for b in arrays if a < b and len(arrays[a] & arrays[b]) >= 0.8 * len(arrays[a] | arrays[b])}
    assert want <= pairs and len(pairs) < len(arrays) ** 2 / 4


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(2)
    e = rng.integers(0, 2**62, 300).astype(np.uint64)
    w = rng.uniform(0.5, 3, 300)
    a, b = e[:250], e[50:]
    wa, wb = w[:250], w[50:] * 1.5
    ea, eb = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    every = sorted(set(ea) | set(eb))
    x, y = (np.array([d.get(k, 0.0) for k in every]) for d in (ea, eb))
    exact = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(every)) if x[i] > 0 and y[i] > 0)
    got = (near_dedup.signature(a, wa, 4096) == near_dedup.signature(b, wb, 4096)).mean()
    assert got == pytest.approx(exact, abs=0.04)


def test_hot_groups_equal_brute_force(spark, monkeypatch):
    """Groups of copies and of near copies, and a text's hub, beyond the bound at which keys are dealt to several tasks."""
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 5)
    monkeypatch.setattr(near_dedup, "HOT_SHARE", 10**6)
    monkeypatch.setattr(near_dedup, "SPLIT_ROWS", 0)
    rng = random.Random(12)
    word = lambda: "w%d" % rng.randint(0, 5000)
    base = [word() for _ in range(60)]
    texts = [" ".join(base)] * 30
    for _ in range(60):
        now = list(base)
        now[rng.randrange(60)] = word()
        texts.append(" ".join(now))
    texts += [" ".join(word() for _ in range(30)) for _ in range(40)]
    texts = dict(enumerate(texts))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()} == brute_classes(texts)


def test_counters_count_texts(spark):
    df = spark.createDataFrame(list(planted().items()), "doc_id long, text string").repartition(5)
    sets = near_dedup.prepare(df, 4, 4, "doc_id", "text").select("shingles").cache()
    want = np.zeros(near_dedup.COUNTERS, np.int64)
    for r in sets.collect():
        np.add.at(want, near_dedup.unpacked_set(bytes(r["shingles"])) & (near_dedup.COUNTERS - 1), 1)
    assert (near_dedup.shingle_counts(sets) == want).all() and want.max() > 50


def test_repeated_ids_are_one_document(spark):
    a, b, c = ("one two three four five six seven " * 3, "alpha beta gamma delta epsilon zeta " * 3, "another text altogether with its own words here")
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b), (7, c), (7, c)], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()} == {1: 1, 5: 1, 9: 1, 7: 7}


def test_near_duplicates_of_odd_tables(spark, odd):
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(odd).collect()}
    assert set(got) == {*range(len(ODD)), None} and got[3]["class_id"] == 3 and got[None]["class_id"] is None
    assert got[4]["class_id"] == 4
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(0)
    edges = [(a, a + 1) for a in range(0, 40)] + [(100 + rng.randint(0, 30), 100 + rng.randint(31, 60)) for _ in range(40)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(k, k) == v for k, v in root.items())


# -- 4: nearest neighbours


def test_chi_square():
    rng = np.random.default_rng(0)
    x = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert (x < ann.chi_square_bound(0.9, 8)).mean() == pytest.approx(0.9, abs=0.005)


def test_neighbours_recall_and_scores(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = ann.nearest(e, F.col("vec_id") % 50 == 0).collect()
    pdf = e.toPandas().sort_values("vec_id")
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    length = np.sqrt((x**2).sum(axis=1))
    hits = 0
    for q in ids[ids % 50 == 0]:
        k = int(np.flatnonzero(ids == q)[0])
        s = x @ x[k] / (length * length[k])
        s[k] = -9
        top = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and all(abs(r["score"] - s[np.flatnonzero(ids == r["vec_id"])[0]]) < 1e-12 for r in own)
        assert all(a["score"] > b["score"] or a["score"] == b["score"] and a["vec_id"] < b["vec_id"] for a, b in zip(own, own[1:]))
        hits += len(top & {r["vec_id"] for r in own})
    assert hits / len(rows) >= 0.9


def _recall(x, ids, queries, k=5):
    """Share of the true neighbours found, and share of the shard that was verified."""
    shard, bound, length = ann.Shard(ids, x), ann.chi_square_bound(ann.SURE, ann.DIMS), np.sqrt((x**2).sum(axis=1))
    hits = verified = 0
    for q in queries:
        found, _, n = shard.search(ids[q], x[q], k, bound)
        s = x @ x[q] / (length * length[q])
        s[q] = -9
        hits += len(set(ids[np.lexsort((ids, -s))[:k]].tolist()) & set(found.tolist()))
        verified += n
    return hits / k / len(queries), verified / len(queries) / len(x)


def test_the_stopping_test_saves_work():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((200, 64))
    clustered = centres[rng.integers(0, 200, 16_384)] + 0.3 * rng.standard_normal((16_384, 64))
    recall, share = _recall(clustered, np.arange(16_384), range(0, 16_384, 200))
    assert recall >= 0.9 and share < 0.03
    recall, share = _recall(rng.standard_normal((16_384, 64)), np.arange(16_384), range(0, 16_384, 400))
    assert recall >= 0.9 and share < 0.9


def test_points_come_in_the_order_of_their_distance():
    points = np.random.default_rng(3).standard_normal((5000, ann.DIMS))
    q = points[7] + 0.1
    near = np.concatenate([d for d, _ in ann.KdTree(points).incremental(q)])
    assert len(near) == 5000 and (np.diff(near) >= 0).all()


def test_many_shards_find_the_same(spark):
    """Several cells and split cells: recall against brute force over all of them."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 2000)] + 0.3 * rng.standard_normal((2000, 16)), np.ones((700, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    rows = ann.nearest(df, F.col("vec_id") % 50 == 0, shard_rows=256).collect()
    length, hits, want = np.sqrt((x**2).sum(axis=1)), 0, 0
    for q in range(0, len(x), 50):
        s = x @ x[q] / (length * length[q])
        s[q] = -9
        own = [r for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(own) == 5 and all(abs(r["score"] - s[r["vec_id"]]) < 1e-12 for r in own)
        hits += sum(abs(s[r["vec_id"]] - t) < 1e-12 for r, t in zip(own, np.sort(s)[::-1]))
        want += 5
    assert hits / want >= 0.9


def test_neighbours_of_odd_vectors(spark):
    v = [1.0, 0.0, 2.0]
    rows = [(i, v, 1) for i in range(0, 12)] + [(50, v, 1), (50, v, 1), (60, None, 1), (61, [0.0] * 3, 1), (62, [1.0, None, 2.0], 1), (63, [float("nan")] * 3, 1), (None, v, 1), (100, [1.0, 2.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    of = lambda q: [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
    assert of(0) == [1, 2, 3, 4, 5] and of(50) == [0, 1, 2, 3, 4] and of(100) == []
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# -- 3: HTML


PAGE = "<html><head><title>t</title></head><body><div class='top-menu'><a href='/'>Home</a></div><div class=page><div class=entry><h1>{h}</h1>{body}</div><div id=sidebar>side {h}</div></div><section class=comments><p>nice {h}</p></section><div class='cookie-notice'>cookies</div><form><p>form</p></form><footer>foot</footer></body></html>"


def test_wrapper_finds_the_article():
    pages = [PAGE.format(h=f"Title {k}", body="".join(f"<p>Paragraph {k} {j} of &amp; text\n with  <b>bold</b> words and more" for j in range(3 + k))) for k in range(4)]
    w = html_wrapper.infer(pages)
    assert w.path[-1][:2] == ["div", "entry"] and "(<p>#</p>)+" in w.expression
    assert html_wrapper.main_text(pages[0], w) == "Title 0\n" + "\n".join(f"Paragraph 0 {j} of & text with bold words and more" for j in range(3))


def test_wrapper_terms():
    w = html_wrapper.infer(["<ul><li>a<li>b</ul><p>x", "<ul><li>c</ul><p>y<div>z</div>", "<ul><li>d<li>e<li>f</ul><p>z"])
    assert w.expression == "<ul>(<li>#</li>)+</ul><p>#</p>(<div>#</div>)?"


def _read(pages):
    w = html_wrapper.infer(pages)
    return [html_wrapper.main_text(p, w) for p in pages], [html_wrapper.main_text(p, html_wrapper.Wrapper()) for p in pages]


def test_the_slots_decide():
    """Without article elements and telling names: constants go, also beside paragraphs and around tiny articles."""
    tiny = ["<body><div><a href=/>Home</a></div><div>Acme Daily, news for the whole town</div><p>tiny %d</p><div>Copyright Acme Inc of nowhere</div></body>" % k for k in range(5)]
    read, bare = _read(tiny)
    assert read == [f"tiny {k}" for k in range(5)] and all("Acme" in x for x in bare)
    beside = ["<body><div><p>Acme Daily, news for the whole town</p><p>one of %d</p><p>two of %d</p><p>Copyright Acme</p></div></body>" % (k, k) for k in range(5)]
    read, bare = _read(beside)
    assert read == [f"one of {k}\ntwo of {k}" for k in range(5)] and all("Acme" in x for x in bare)
    columns = ["<body><div><a>m1</a><a>m2</a></div><div><h2>T%d</h2><p>%s</p><p>%s</p></div><div><p>side %d</p></div></body>" % (k, f"word{k} " * 30, f"term{k} " * 20, k) for k in range(5)]
    read, _ = _read(columns)
    assert read == [f"T{k}\n" + (f"word{k} " * 30).strip() + "\n" + (f"term{k} " * 20).strip() for k in range(5)]


def test_telling_words_within_names_are_not_enough():
    pages = ["<article><p class='share-market-news'>Stocks %d</p><div class='menu-of-the-day'>Soup %d</div><p class='notice-period'>Weeks %d</p><section id='related-work'>Work %d</section><p>x <math>y %d</math></p><div class='share-buttons'>tweet %d</div></article>" % ((k,) * 6) for k in range(4)]
    read, bare = _read(pages)
    assert read == bare == [f"Stocks {k}\nSoup {k}\nWeeks {k}\nWork {k}\nx y {k}" for k in range(4)]


def test_a_telling_name_around_nearly_everything():
    pages = ["<body><div class='sidebar right'><p>%s</p><p>%s</p></div><p>x</p></body>" % (f"long{k} " * 40, f"more{k} " * 30) for k in range(4)]
    assert all(len(x.split()) == 70 for x in _read(pages)[0])


@pytest.mark.parametrize("box", ["<div class='comments'>%s</div>", "<div class='reader-comments'>%s</div>", "<div class='zone'>%s</div>"])
@pytest.mark.parametrize("many", [20, 60, 100])
def test_comments_are_no_article(box, many):
    """However long the comments are, and whatever their box is called, the article is the short text before them."""
    pages = []
    for k in range(8):
        records = "".join(f"<div class='c'><b>name{k}{j}</b><span>said {j} of {k} at some length, and then some more</span></div>" for j in range(many + k))
        pages.append(f"<body><div class='head'><a href='/'>Home</a></div><div class='story'><h1>Title {k}</h1><p>{f'first{k} ' * 20}</p><p>{f'second{k} ' * 15}</p></div>{box % records}</body>")
    for k, text in enumerate(_read(pages)[0]):
        assert text == f"Title {k}\n{(f'first{k} ' * 20).strip()}\n{(f'second{k} ' * 15).strip()}"


def test_comments_within_main():
    pages = ["<body><main><h1>Title %d</h1><p>%s</p><div class='reader-comments'><p>nice %d</p><p>very nice</p></div></main></body>" % (k, f"word{k} " * 20, k) for k in range(4)]
    assert _read(pages)[0] == [f"Title {k}\n" + (f"word{k} " * 20).strip() for k in range(4)]


def test_an_article_of_boxes_stays_whole():
    """Paragraphs in boxes of their own, with nothing beside them, are an article."""
    pages = ["<body><div class='text'>" + "".join(f"<div class='para'><span>part {j} of {k} {'word ' * 12}</span></div>" for j in range(5 + k)) + "</div></body>" for k in range(5)]
    assert all(f"part {j} of {k}" in text for k, text in enumerate(_read(pages)[0]) for j in range(5 + k))


def test_copies_of_an_article_are_no_template():
    body = "<p>" + "a sentence of the article that many pages copy " * 8 + "</p><p>its end</p>"
    pages = ["<body><article><h1>Title %d</h1>%s</article><div>foot %d</div></body>" % (k, body, k) for k in range(6)]
    assert all("its end" in x and "sentence" in x for x in _read(pages)[0])


def test_wrappers_of_a_hot_host(spark):
    """Two templates of one host, each with its own constants; pages beyond the sample are read through them too."""
    one = [(k, "http://big/a", f"<body><div class=one><p>Alpha Times of today</p><p>story {k} here</p></div></body>") for k in range(60)]
    two = [(100 + k, "http://big/b", f"<body><section class=two><p>Beta Post of tomorrow</p><p>tale {k} there</p></section></body>") for k in range(60)]
    df = spark.createDataFrame(one + two, "page_id long, url string, html string").repartition(7)
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract(df).collect()}
    assert got == {k: f"story {k} here" for k in range(60)} | {100 + k: f"tale {k} there" for k in range(60)}
    assert html_wrapper.wrappers(df).count() == 2


def test_extraction_query(spark):
    sf = "/root/testdata/sf0.01"
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op3_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        want = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r["text"] == "\n".join(x for x in want if x) and r["n_chars"] == len(r["text"])


def test_extraction_of_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "http://h/a", "", "x"), (3, "http://h/b", "no tags at all &lt;", "x"), (4, "nonsense", "<p>a<div>b</p></div></b>", "x"), (5, "http://h/c", "<article>" * 300 + "deep", "x"), (5, "http://h/c", "<article>" * 300 + "deep", "x"), (6, "http://h/d", "<script>var a = '</p>';</script><!-- <p>no</p> -->", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html_wrapper.extract(df).collect())
    assert got == [(1, ""), (2, ""), (3, "no tags at all <"), (4, "a\nb"), (5, "deep"), (5, "deep"), (6, "")]
    assert html_wrapper.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ["div", "span", "article"])
def test_a_hundred_thousand_levels(tag):
    pages = [f"<article><p>start {k}</p>" + f"<{tag}>" * 100_000 + f"<p>deep text number {k}" for k in range(2)]
    assert html_wrapper.main_text(pages[0], html_wrapper.infer(pages)).endswith("deep text number 0")


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a ">' * 200_001, "<div>" * 30_000 + "</p>" * 100_000, "<span>" * 20_000 + "<p>a" * 20_000, "<p><div>" + "<span>" * 30_000 + "<h2>a</h2>" * 30_000, "<p>same" * 30_000])
def test_odd_long_pages_take_linear_time(page):
    pages = [page, page + "y", page + "<p>z"]
    began = time.time()
    html_wrapper.main_text(page, html_wrapper.infer(pages))
    assert time.time() - began < 60


# -- 1: language model


def test_gradient_is_right():
    rng = np.random.default_rng(1)
    net = lm_score.Network()
    net.flat = net.flat.astype(np.float64)
    net.views = net._cut(net.flat)
    [(around, target)] = list(lm_score.windows(rng.integers(0, 1024, 35).astype(np.int16), np.array([30, 0, 5])))
    assert len(target) == 35 and around[0][0] == lm_score.PAD and around[0][30] == lm_score.PAD and around[2][29] == lm_score.PAD
    _, g = net.run(around, target, gradient=True)
    loss = lambda: -net.run(around, target).mean()
    for k in [*np.argsort(-np.abs(g))[:8], *rng.integers(0, net.SIZE, 8)]:
        keep = net.flat[k]
        net.flat[k] = keep + 1e-5
        up = loss()
        net.flat[k] = keep - 1e-5
        slope = (up - loss()) / 2e-5
        net.flat[k] = keep
        assert slope == pytest.approx(g[k], abs=1e-5, rel=1e-2)


def test_probabilities_sum_to_one():
    net = lm_score.Network()
    around = [np.full(1024, 5)] * 4
    assert np.exp(net.run(around, np.arange(1024))).sum() == pytest.approx(1, rel=1e-4)


def _plain_scores(spark, df):
    """Document sums worked out word by word, with plain counts of exact words and the fitted network."""
    encoded = lm_score.encode(df, "doc_id", "text").cache()
    frequent, total = lm_score.output_layer(lm_score.word_counts(encoded, lm_score.part_bits(encoded)))
    net = lm_score.fit(encoded, spark.sparkContext.broadcast(frequent))
    rows = [(r["doc_id"], (r["text"] or "").lower().split()) for r in df.collect()]
    words = Counter(w for _, ws in rows for w in ws)
    top = sorted(words, key=lambda w: (-words[w], lm_score.hash_of(w)))[: lm_score.FREQUENT]
    assert frequent.tolist() == sorted(map(lm_score.hash_of, top))
    own = {w: frequent.tolist().index(lm_score.hash_of(w)) for w in top}
    kind = {w: own.get(w, lm_score.FREQUENT + lm_score.hash_of(w) % lm_score.HASHED) for w in words}
    sums = Counter()
    for w, n in words.items():
        sums[kind[w]] += n
    assert {k: int(n) for k, n in enumerate(total) if n} == sums
    out = []
    for i, ws in rows:
        pll = 0.0
        for j, w in enumerate(ws):
            near = [np.array([kind[ws[k]] if 0 <= k < len(ws) else lm_score.PAD]) for k in (j - 2, j - 1, j + 1, j + 2)]
            pll += float(net.run(near, np.array([kind[w]]))[0]) + np.log(words[w] / sums[kind[w]])
        out.append((i, len(ws), pll))
    return out, words, kind


def test_document_sums_equal_brute_force(spark, docs):
    rng = random.Random(3)
    common = [f"c{k}" for k in range(700)]
    texts = ["c1 c2 abcxyz c3", "c1 c2 defxyz c3"] + [" ".join(rng.choices(common, k=300)) for _ in range(20)] + [" ".join(common * 4)]
    texts += [texts[4], texts[4], texts[5], None, "", "  ", "one", "one"] + [r["text"] for r in docs.limit(12).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want, words, kind = _plain_scores(spark, df)
    got = {r["doc_id"]: r for r in lm_score.score(df).collect()}
    assert len(got) == len(texts)
    for i, n, pll in want:
        assert got[i]["n_tokens"] == n and got[i]["pll"] == pytest.approx(pll, rel=2e-4, abs=2e-3)
    # Given a class its words' shares sum to one.
    shares = Counter()
    for w, n in words.items():
        shares[kind[w]] += n
    assert all(sum(n / shares[k] for w, n in words.items() if kind[w] == k) == pytest.approx(1) for k in set(kind.values()))


def test_words_do_not_share_a_hash():
    import pyarrow.parquet as pq

    words = {w for r in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist() for w in (r or "").lower().split()}
    assert len({lm_score.hash_of(w) for w in words}) == len(words) > 300_000


def test_the_score_knows_the_order_of_words(spark, docs):
    """Documents are likelier than their own words shuffled, which a model without context cannot tell apart."""
    rng = random.Random(7)
    sentence = ["the cat sat on a mat", "a dog ran to the door", "we saw two birds in june", "rain fell over green hills"]
    texts = [" ".join(rng.choice(sentence) for _ in range(60)) for _ in range(150)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts[:10]]
    df = spark.createDataFrame(list(enumerate(texts + mixed)), "doc_id long, text string").repartition(2)
    mean = {r["doc_id"]: r["mean_pll"] for r in lm_score.score(df).collect()}
    assert min(mean[k] for k in range(10)) > max(mean[k] for k in range(150, 160)) + 0.5


def test_chunks_and_parts_change_no_count(spark, docs, monkeypatch):
    """Counts of words are the corpus's, however it is cut."""
    words = Counter(w for r in docs.collect() for w in (r["text"] or "").lower().split())
    want = {lm_score.hash_of(w): n for w, n in words.items()}
    layers = []
    for parts, size in ((1, 2 << 20), (6, 4096)):
        monkeypatch.setattr(lm_score, "COUNTED", size)
        encoded = lm_score.encode(docs.repartition(parts), "doc_id", "text").cache()
        bits = lm_score.part_bits(encoded)
        assert (bits > 3) == (size == 4096)
        counts = lm_score.word_counts(encoded, bits).cache()
        rows = counts.where("chunk is not null").orderBy("chunk", "part").collect()
        for r in encoded.collect():
            own = np.concatenate([np.frombuffer(bytes(c["counts"]), np.int64) for c in rows if c["chunk"] == r["chunk"]])
            assert own.tolist() == [want[h] for h in np.frombuffer(bytes(r["words"]), np.uint64).tolist()]
        layers.append([x.tolist() for x in lm_score.output_layer(counts)])
    assert layers[0] == layers[1]


def test_places_come_back():
    places = np.random.default_rng(1).integers(0, 70_000, 500)
    assert (lm_score._unpacked(lm_score._packed(places, 70_000), 70_000) == places).all()
    assert (lm_score._unpacked(lm_score._packed(places, 1 << 24), 1 << 24) == places).all()


def test_scores_of_odd_tables(spark, odd):
    rows = lm_score.score(odd).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count() and (got[0]["n_tokens"], got[0]["pll"], got[3]["n_tokens"]) == (0, 0.0, 0)
    assert lm_score.score(odd.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "word other " * 400_000), (2, "x" * 2_000_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in lm_score.score(long).collect()} == {1: 800_000, 2: 1}


# -- the pipeline


def test_pipeline(spark, tmp_path, coder):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == columns
        before = {r["doc_id"]: r["text"] for r in now.collect()}
        kept = {r["doc_id"] for r in after.collect()}
        assert kept <= set(before)
        if name == "near_dedup":
            assert kept == {i for i, c in brute_classes(before).items() if i == c}
        now = after
    _, lib = coder
    rows = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    assert _check_packing(rows, {r["doc_id"]: r["text"] for r in now.collect()}, lib, 2048) > 0.97
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = spark.read.parquet(str(tmp_path / "quality"))
    assert np.mean([labels[r["doc_id"]] for r in good.select("doc_id").collect() if r["doc_id"] in labels]) > 0.98


def test_language_stage_rejects_other_languages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(6)
    random_letters = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 10))) for _ in range(60))
    other = ["Szczęśliwy człowiek źdźbło trawy przyniósł żółwiowi którzy wszystkich mieszkańców dzień wśród łąk " * 3, "यह एक हिन्दी वाक्य है जिसमें कई शब्द हैं " * 5, "Это предложение написано на русском языке и состоит из многих слов " * 3]
    odd = other + [random_letters() for _ in range(5)] + ["1234 !!", None]
    extra = spark.createDataFrame([(10**9 + k, t, None, "s", len(t or "")) for k, t in enumerate(odd)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.union(extra), "/root/testdata/sf0.01").collect()}
    assert not any(i >= 10**9 for i in kept)
    assert len(kept) > 0.99 * docs.count()


def test_pipeline_stages_on_odd_tables(spark, odd, tmp_path):
    import corpus_pipeline

    docs = odd.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), "score")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.count() >= 0
    assert corpus_pipeline.distinct_documents(spark, docs, SF).where("doc_id = 4").count() == 1
    left = {r["doc_id"] for r in corpus_pipeline.distinct_documents(spark, docs, SF).collect()}
    assert None in left and 3 in left


def test_different_texts_of_one_id_stay(spark):
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(1, text(1)), (1, text(2)), (1, text(1)), (2, text(2)), (3, text(3)), (None, text(4)), (None, text(4)), (None, text(3)), (4, None)]
    docs = spark.createDataFrame([(i, t, "row_key", 1.0) for i, t in rows], "doc_id long, text string, row_key string, key double")
    got = sorted(((r["doc_id"] or 0, (r["text"] or "")[:4]) for r in corpus_pipeline.distinct_documents(spark, docs, SF).collect()))
    assert got == [(0, "w4x0"), (1, "w1x0"), (1, "w2x0"), (3, "w3x0"), (4, "")]
