"""Collocations: phrases that are more frequent than their parts suggest (operator 12).

Texts become pieces between punctuation marks. Identical pieces are one row with a multiplicity, so that boilerplate is
read once. Phrases are then counted by length. Each task counts the phrases of its pieces, weighted by multiplicity,
and passes its sums on by the hashes of their words; DuckDB adds up each bucket, out of core, and keeps the frequent
ones. A word's 64-bit hash stands for it: all words of the corpus are checked to have different ones, and another
seed is taken if two have not, so this loses nothing.

A phrase is only counted if its words and pairs of words may be frequent: a bitmap of fixed size holds the hashes of
the frequent ones. It may let a rare phrase through, never keep a frequent one back, so all counts are exact.

The parts of a candidate have their counts elsewhere. For each cut a request goes to the bucket of the part, and the
answers meet again at the candidate; requests for a part that very many candidates have are dealt to several tasks.
"""

from __future__ import annotations

import itertools
import re
import tempfile
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, release, shared_table, small_batches
from .near_dedup import split_join

#: Longest phrase, fewest occurrences of a candidate, rows returned for each language, scale of the score.
WORDS, OCCURRENCES, BEST, SCALE = 5, 100, 2000, 1000
#: The language of rows without one.
UNKNOWN = "und"
#: Bits of the map of frequent phrases (16 MB), whatever the data.
BITS = 1 << 27
#: Characters of texts, and bytes of pieces, that a task holds before it passes its counts on.
HELD_CHARS, HELD_BYTES = 16 << 20, 12 << 20
#: Pieces that are split into words at once.
_CHUNK = 2048
#: Rows of partial counts in a batch.
_ROWS = 1 << 18
#: Memory of DuckDB for a bucket; beyond it DuckDB goes to the task's scratch folder.
MEMORY = "256MB"
#: Tasks that choose the best phrases of one language before the last choice.
SALTS = 64
_SPACES = re.compile(rb"  +")
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_HASHES = [f"h{k}" for k in range(1, WORDS + 1)]
_GOLDEN, _C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def split(text: str) -> list[bytes]:
    """The pieces of a text that have words, each with its lower-cased words (A-Z only) joined by one space. Bytes,
    since all marks are ASCII and other characters stay as they are."""
    t = text.encode("utf-8", "surrogatepass").lower().translate(_PIECES)
    if b"  " in t:
        t = _SPACES.sub(b" ", t)
    pieces = t.replace(b" \n", b"\n").replace(b"\n ", b"\n").strip(b" \n").split(b"\n")
    return list(filter(None, pieces)) if b"" in pieces else pieces


def word_hashes(lang: str, words: list[bytes], seed: int) -> np.ndarray:
    head = f"{seed}\t{lang}\t".encode()
    return pd.util.hash_array(np.array([head + w for w in words], dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


class Block:
    """Pieces of some texts, to count their phrases by sorting numbers of words; 0 stands between pieces."""

    def __init__(self, seed: int):
        self.seed, self.pieces = seed, {}

    def add(self, lang: str, pieces: list[bytes], times: list[int]) -> None:
        held = self.pieces.setdefault(lang, ([], []))
        held[0].extend(pieces)
        held[1].extend(times)

    def close(self) -> None:
        at, weight, self.words, hashes = [], [], [(UNKNOWN, b"")], [np.zeros(1, np.uint64)]
        for lang, (pieces, times) in self.pieces.items():
            numbers, before = {b"\n": 0}, len(self.words)
            for k in range(0, len(pieces), _CHUNK):  # few words at a time as objects
                some = pieces[k : k + _CHUNK]
                tokens = b" \n ".join(some).split(b" ")
                for w in sorted(set(tokens) - numbers.keys()):
                    numbers[w] = len(self.words)
                    self.words.append((lang, w))
                ids = np.zeros(len(tokens) + 1, np.int64)
                ids[:-1] = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
                at.append(ids)
                weight.append(np.repeat(np.array(times[k : k + _CHUNK], np.int64), np.diff(np.flatnonzero(ids == 0), prepend=-1)))
            hashes.append(word_hashes(lang, [w for _, w in self.words[before:]], self.seed))
        self.at, self.weight, self.hashes, self.pieces = np.concatenate(at), np.concatenate(weight), np.concatenate(hashes), {}
        self.width = max(1, len(self.words).bit_length())

    def word_sums(self) -> np.ndarray:
        """The weight of each word; that of number 0 has no meaning."""
        order = np.argsort(self.at)
        first = np.flatnonzero(np.diff(self.at[order], prepend=-1))
        sums = np.zeros(len(self.words), np.int64)
        sums[self.at[order[first]]] = np.add.reduceat(self.weight[order], first)
        return sums

    def counts(self, least: int, most: int, known: int, bits: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """(hashes of the words, sums) of the phrases of each length from least to most whose runs of ``known`` words
        may all be frequent."""
        at, h = self.at, self.hashes
        n = len(at) - known + 1
        if n <= 0:
            return
        if known == 1:
            ok = _known(bits, h)[at] & (at > 0)
        else:
            run = h[at]
            key, ok = run[:n], at[:n] > 0
            for k in range(1, known):
                key, ok = longer(key, run[k : k + n]), ok & (at[k : k + n] > 0)
            ok &= _known(bits, key)
        for k in range(least, most + 1):
            size = len(at) - k + 1
            if size <= 0:
                return
            good = ok[:size].copy()
            for j in range(1, k - known + 1):
                good &= ok[j : j + size]
            place = np.flatnonzero(good)
            if not len(place):
                return
            code, width = at[place], self.width
            for j in range(1, k):
                if width + self.width > 62:  # dense numbers for the words so far
                    code = np.unique(code, return_inverse=True)[1].ravel()
                    width = len(code).bit_length()
                code = code << np.int64(self.width) | at[place + j]
                width += self.width
            order = np.argsort(code)
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            begin = place[order[first]]
            yield [h[at[begin + j]] for j in range(k)], np.add.reduceat(self.weight[place[order]], first)


def longer(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    return _mix(hashes * _GOLDEN + more)


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def pieces_and_words(docs: DataFrame, lang_col: str, text_col: str, seed: int) -> DataFrame:
    """lang, piece, h, m: the distinct pieces with their multiplicities (h null) and all words with their hashes and
    numbers. Tasks add up their own before the shuffle."""
    small_batches(docs.sparkSession)
    names = ["lang", "piece", "h", "m"]

    def made(total: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        block = Block(seed)
        for lang, counts in total.items():
            pieces, m = list(counts), list(counts.values())
            block.add(lang, pieces, m)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(m)), pa.array(pieces, pa.binary()), pa.nulls(len(m), pa.int64()), pa.array(m, pa.int64())], names=names)
        total.clear()
        block.close()
        words = block.words[1:]
        yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in words], pa.string()), pa.array([w[1] for w in words], pa.binary()), pa.array(block.hashes[1:].view(np.int64)), pa.array(block.word_sums()[1:])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = defaultdict(Counter)
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    found = split(text)
                    if found:
                        total[lang].update(found)
                    held += len(text)
            if held >= HELD_CHARS and total:
                yield from made(total)
                held = 0
        if total:
            yield from made(total)
        release()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, piece binary, h long, m long").groupBy("lang", "piece", "h").agg(F.sum("m").alias("m"))


def _counted(least: int, most: int, known: int, seed: int, shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shipped.value, np.uint8)
        block, held = Block(seed), 0

        def out():
            block.close()
            for hashes, sums in block.counts(least, most, known, bits):
                size = 8 * len(hashes)
                for k in range(0, len(sums), _ROWS):
                    some = sums[k : k + _ROWS]
                    data = pa.py_buffer(np.column_stack([h[k : k + _ROWS] for h in hashes]))
                    ends = pa.py_buffer(np.arange(0, size * len(some) + 1, size, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(some), [None, ends, data]), pa.array(some)], names=["words", "a"])

        for batch in batches:
            langs, pieces, times = (c.to_pylist() for c in batch.columns)
            some = set(langs)
            for lang in some:
                if len(some) == 1:
                    block.add(lang, pieces, times)
                else:
                    at = [k for k, x in enumerate(langs) if x == lang]
                    block.add(lang, [pieces[k] for k in at], [times[k] for k in at])
            held += batch.column(1).nbytes
            if held >= HELD_BYTES:
                yield from out()
                block, held = Block(seed), 0
        if held:
            yield from out()
        block = None
        release()

    return run


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one bucket's phrases, by DuckDB: it reads the batches as they come and spills what it must."""
    import duckdb

    with tempfile.TemporaryDirectory(prefix="counts-", ignore_cleanup_errors=True) as scratch:
        with duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": scratch, "preserve_insertion_order": False}) as con:
            con.register("counts", pa.RecordBatchReader.from_batches(pa.schema([("words", pa.binary()), ("a", pa.int64())]), batches))
            for found in con.sql(f"SELECT words, sum(a)::BIGINT AS a FROM counts GROUP BY words HAVING sum(a) >= {OCCURRENCES}").to_arrow_reader(20_000):
                rows = np.zeros((found.num_rows, WORDS), np.int64)
                for k, x in enumerate(found.column(0)):
                    own = np.frombuffer(x.as_buffer(), np.int64)
                    rows[k, : len(own)] = own
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows.T.copy()), found.column(1)], names=[*_HASHES, "a"])
    release()


def frequent(pieces: DataFrame, least: int, most: int, known: int, seed: int, shipped) -> DataFrame:
    """The hashes of the words (0 beyond the last) and the number of the phrases that occur often enough."""
    counted = pieces.mapInArrow(_counted(least, most, known, seed, shipped), "words binary, a long")
    schema = ", ".join(f"{h} long" for h in [*_HASHES, "a"])
    return shared_table(counted.repartition("words").mapInArrow(_bucket, schema))


def bitmap(hashes: DataFrame):
    """The bits of the hashes (one column of 64-bit numbers): at most BITS of them, built by Spark in blocks."""
    # Buckets are numbered from 1 and hold positions 1 to 32768 before it; bit 0 of the map is position 1.
    at = hashes.select((F.col(hashes.columns[0]).bitwiseAND(F.lit(BITS - 1)) + 1).alias("bit"))
    blocks = at.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for b in blocks:
        part = np.frombuffer(bytes(b["bits"]), np.uint8)
        at_ = (b["block"] - 1) * len(part)
        out[at_ : at_ + len(part)] = part[: len(out) - at_]
    return hashes.sparkSession.sparkContext.broadcast(out.tobytes())


def _pair_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second = (c.to_numpy().view(np.uint64) for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array(longer(first, second).view(np.int64))], names=["h"])


def named(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a: the phrases by their words again, which are all frequent."""
    out = phrases
    for k, h in enumerate(_HASHES):
        some = words.select(F.col("h").alias(h), F.col("phrase").alias(f"w{k}"), *([F.col("lang")] if k == 0 else []))
        out = out.join(some, h, "inner" if k < 2 else "left")
    return out.select("lang", F.concat_ws(" ", *[f"w{k}" for k in range(WORDS)]).alias("phrase"), "a")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", best: int = BEST) -> DataFrame:
    """The best-scored phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts have no words; a null language is ``und``; repeated rows count as often as they occur. A text of any
    length is read whole, also one without any mark. Ties go by a, then by phrase in byte order. A table without
    phrases that are frequent enough, or an empty one, gives no rows. Columns other than language and text are not read.
    """
    for seed in itertools.count():
        rows = shared_table(pieces_and_words(docs, lang_col, text_col, seed), "zstd")
        every = rows.where("h is not null")
        if every.groupBy("h").count().where("count > 1 or h = 0").isEmpty():
            break
    totals = cut(every.groupBy("lang").agg(F.sum("m").alias("n")))
    words = cut(every.where(F.col("m") >= OCCURRENCES).select("lang", F.col("piece").cast("string").alias("phrase"), "h", F.col("m").alias("a")))
    pieces = rows.where("h is null").select("lang", "piece", "m")
    two = frequent(pieces, 2, 2, 1, seed, bitmap(words.select("h")))
    more = frequent(pieces, 3, WORDS, 2, seed, bitmap(two.select("h1", "h2").mapInArrow(_pair_hashes, "h long")))
    return scored(totals, words.select("lang", "phrase", "a"), cut(named(two.unionByName(more), words)), best)


def scored(totals: DataFrame, words: DataFrame, phrases: DataFrame, best: int) -> DataFrame:
    """Candidates with their lowest cut, without those that a longer one holds, the best of each language."""
    counts = words.unionByName(phrases)
    candidates = counts.where(F.col("phrase").contains(" "))
    w = F.split("phrase", " ")
    joined = lambda begin, size: F.concat_ws(" ", F.slice("w", begin, size))
    cuts = candidates.withColumn("w", w).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    asked = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    # Two requests for each cut, to the buckets of its parts.
    requests = asked.select("lang", "phrase", "a", "k", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("first").alias("p")), F.struct(F.lit(1).alias("side"), F.col("rest").alias("p")))).alias("q"))
    requests = requests.select("phrase", "a", "k", "q.side", F.struct("lang", F.col("q.p").alias("p")).alias("part"))
    answers = split_join(requests, counts.select(F.struct("lang", F.col("phrase").alias("p")).alias("part"), F.col("a").alias("f")), "part", "phrase")
    side = lambda s, name: F.max(F.when(F.col("side") == s, F.col("f"))).alias(name)
    met = answers.groupBy(F.col("part.lang").alias("lang"), "phrase", "a", "k").agg(side(0, "l"), side(1, "r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    met = met.join(F.broadcast(totals), "lang").withColumns({"top": (F.col("a") * SCALE).cast("decimal(19,0)") * wide("n"), "under": wide("l") * wide("r")})
    lowest = met.withColumn("score", F.expr("top div under")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    # The two phrases that are one word shorter: if any longer one is as frequent, one of these steps is.
    inner = candidates.withColumn("w", w).where(F.size("w") > 2)
    shorter = F.explode(F.array_distinct(F.array(joined(F.lit(1), F.size("w") - 1), joined(F.lit(2), F.size("w") - 1))))
    held = inner.select("lang", shorter.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    left = lowest.join(held, ["lang", "phrase"], "left").where(~F.coalesce(F.col("over") >= F.col("a"), F.lit(False)))
    rows = left.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    some = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= best)
    top = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return top.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
