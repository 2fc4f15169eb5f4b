"""Near-duplicate classes by ProbMinHash, banding and verification (operator 8).

A text is the set of its runs of five words. In ProbMinHash every element is a Poisson process whose rate is its
weight; each arrival falls on a random component of the signature, and a component keeps the element that arrives
first. Elements stop once they are later than every component's first arrival. Two signatures agree at a component
with the probability Jaccard similarity of the texts. Here every distinct run weighs 1, however often it occurs, so
this is the Jaccard similarity of the sets. Bands of components bring candidates together, and the exact similarity
of the sets decides.

Copies of a text are one node from the start. Within a band's bucket each node is first compared with the smallest
and the largest node only, so a bucket gives as many candidates as it has nodes. Where these links leave several
classes in a bucket, its texts go through an exact prefix-filtered join: with the shingles of each set in one common
order, rare ones first, two sets of similarity t share one of the first (1 - t) n + 1. Shingles that many texts share
come last and hardly ever meet, so a common passage costs little, and no link of these texts is lost. How often a
shingle occurs is read from a table of counters of fixed size, summed over all these texts.

Joins deal the rows of hot keys (a text with many copies, a bucket of many near copies, the centre of a class) to
several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_columns, release, shared_table, small_batches, summed_counters

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 misses all of 32 bands of 6 with probability 6e-5.
BANDS, ROWS = 32, 6
#: Bytes of a shingle's hash in the sets that are compared.
SET_BYTES = 5
#: Counters of shingles (a power of two); the most ids that are broadcast (8 bytes each).
COUNTERS, BROADCAST_IDS = 1 << 21, 1_000_000
#: A key is hot with more than a thousandth of the rows (so at most a thousand keys are), and this many at least; its
#: rows go to so many tasks.
HOT_SHARE, HOT_ROWS, SALTS = 1000, 500, 64
#: Edges (16 bytes each) from which on the joins of the components look for hot keys.
SPLIT_ROWS = 1 << 20
_WORD = re.compile(r"\w+")
_GOLDEN, _C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def shingles(words: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes, weights) of the distinct runs of words; a shorter text is one run. All weigh 1, since the
    links are defined by the sets: other weights would keep texts apart that repeat a line more or less often."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = max(1, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        total = total * _GOLDEN + h[k : k + n]
    distinct = np.unique(_mix(total))
    return distinct, np.ones(len(distinct))


def signature(elements: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The ProbMinHash signature: the element that arrives first at each of m components."""
    n = len(elements)
    low = np.uint64((1 << max(20, n.bit_length())) - 1)
    first = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    active, start, at = np.arange(n), np.zeros(n), 0
    # About m (ln m + 3) arrivals fill all components; more rounds follow where they do not.
    per = max(1, int(np.ceil(m * (np.log(m) + 3) / max(weights.sum(), 1e-9) * float(weights.mean()))))
    while len(active):
        steps = np.arange(at + 1, at + per + 1, dtype=np.uint64) * _GOLDEN
        r = _mix(elements[active][:, None] + steps)
        gap = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[active][:, None]
        time = np.cumsum(gap, axis=1) + start[active][:, None]
        start[active] = time[:, -1]
        packed = (time.view(np.uint64) & ~low) | active.astype(np.uint64)[:, None]
        component = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(m)) >> np.uint64(32)
        np.minimum.at(first, component.ravel().astype(np.intp), packed.ravel())
        latest = (first.max() & ~low).view(np.float64) if first.max() != np.iinfo(np.uint64).max else np.inf
        active = active[start[active] < latest]
        at += per
        per = max(1, per // 2)
    return elements[(first & low).astype(np.intp)]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    key = np.arange(1, bands + 1, dtype=np.uint64) * _C2
    for column in sig.reshape(bands, rows).T:
        key = _mix(key * _GOLDEN + column)
    return key.view(np.int64)


def packed_set(elements: np.ndarray) -> bytes:
    """The elements' highest SET_BYTES bytes, sorted, without repeats: two different shingles of a pair of texts with
    a thousand shingles each share one with probability 1e-6."""
    short = np.unique(elements >> np.uint64(64 - 8 * SET_BYTES))
    return short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def unpacked_set(data) -> np.ndarray:
    """The sorted elements of a packed set."""
    raw = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :SET_BYTES] = raw
    return out.view("<i8").ravel()


def prepare(docs: DataFrame, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """id, key (digest of the word sequence), keys (of the bands), shingles (packed) of every text.

    Words are compared without case and punctuation. A text without words has no shingles and is known by itself."""

    def make():
        def run(ids, texts):
            key, band, sets = [], [], []
            for t in texts:
                words = _WORD.findall(t.lower())
                joined = " ".join(words) if words else "\n" + t
                key.append(blake2b(joined.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                elements, weights = shingles(words)
                band.append(band_keys(signature(elements, weights, bands * rows), bands, rows) if words else None)
                sets.append(packed_set(elements))
            return [ids, key, band, sets]

        return run

    kept = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_columns(kept, ["id", "text"], "id long, key binary, keys array<long>, shingles binary", make)


def split_join(left: DataFrame, right: DataFrame, key: str, spread: str, counts: DataFrame | None = None) -> DataFrame:
    """``left.join(right, key)`` for a ``right`` that is unique by key: the left rows of a hot key go to several tasks
    by their ``spread`` column, and the right row to each of these. ``counts`` (key, n) is how often the left keys
    occur, where that is known already."""
    counts = left.groupBy(key).agg(F.count("*").alias("n")) if counts is None else counts.select(key, "n")
    rows, most = counts.agg(F.sum("n"), F.max("n")).first()
    least = max(HOT_ROWS, (rows or 0) // HOT_SHARE)
    if (most or 0) <= least:
        return left.join(right, key)
    hot = cut(counts.where(F.col("n") > least).select(key, F.lit(True).alias("hot")))  # at most HOT_SHARE rows
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("salt", salt).drop("hot")
    copied = right.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(salts)).drop("hot")
    return dealt.join(copied, [key, "salt"]).drop("salt")


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is among the distinct ids, which are broadcast up to a checked number and joined beyond it."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least the similarity."""
    pairs = cut(pairs)
    needed = cut(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    sets = _among(sets, needed).dropDuplicates(["id"])
    both = split_join(pairs, sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a", "b")
    both = split_join(both, sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b", "a", pairs.groupBy("b").agg(F.count("*").alias("n")))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = unpacked_set(x.as_buffer()), unpacked_set(y.as_buffer())
                few, many = sorted((len(x), len(y)))
                if few < similarity * many - 1e-9:
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (few + many - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    small_batches(pairs.sparkSession)
    return both.select("a", "b", "x", "y").mapInArrow(test, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node each node of the edges (a, b) is connected with, by alternating stars."""

    def met(pairs: DataFrame, many: bool) -> DataFrame:
        """Each (u, v) with m, the least v of its u."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if not many:
            return pairs.join(least.drop("n"), "u")
        least = cut(least)
        return split_join(pairs, least.drop("n"), "u", "v", least)

    def large(e: DataFrame, many: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        return met(both, many).where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()

    def small(e: DataFrame, many: bool) -> DataFrame:
        joined = met(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), many)
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").union(joined.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    state = (edges.count(), None)
    while True:
        # Below this number of rows a centre's are few enough for one task.
        many = state[0] > SPLIT_ROWS
        stars = large(edges, many)
        edges = cut(small(cut(stars) if many else stars, many))
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many texts have a shingle of each counter: one vector of fixed size."""

    def tally(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            if batch.num_rows:
                held = [unpacked_set(x.as_buffer()) & (COUNTERS - 1) for x in batch.column(0)]
                at, n = np.unique(np.concatenate(held), return_counts=True)
                counts[at] += n
        return counts

    small_batches(sets.sparkSession)
    return summed_counters(sets.select("shingles"), tally, COUNTERS)


def prefix_pairs(sets: DataFrame, apart: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b), of different classes, among the texts of ``apart`` (id, class): all that may have the
    similarity. The order of shingles is by their counters and then by value; any order is right, this one is fast."""
    own = shared_table(_among(sets, apart.select("id").distinct()).dropDuplicates(["id"]))
    shipped = own.sparkSession.sparkContext.broadcast(shingle_counts(own))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shipped.value
        for batch in batches:
            ids, toks, places, sizes = [], [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = unpacked_set(x.as_buffer())
                n = counts[x & (COUNTERS - 1)]
                keep = len(x) - int(np.ceil(similarity * len(x) - 1e-9)) + 1
                first = x[np.lexsort((x, n))[:keep]]
                ids.append(np.full(len(first), i))
                toks.append(first)
                places.append(np.arange(len(first)))
                sizes.append(np.full(len(first), len(x)))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (ids, toks, places, sizes)], names=["id", "tok", "place", "size"])

    rows = own.select("id", "shingles").mapInArrow(prefixes, "id long, tok long, place long, size long").join(apart, "id")
    several = rows.groupBy("tok").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 < c1").select("tok")
    rows = cut(rows.join(several, "tok", "left_semi"))
    x, y = rows.alias("x"), rows.alias("y")
    # At most this many shingles can be common: the one met here and what follows it in either set.
    most = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    enough = most >= similarity / (1 + similarity) * (F.col("x.size") + F.col("y.size")) - 1e-9
    fits = (F.col("x.size") >= similarity * F.col("y.size")) & (F.col("y.size") >= similarity * F.col("x.size"))
    met = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.class") != F.col("y.class")) & fits & enough)
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id, text_id.

    class_id is the smallest id of the document's class: copies, and texts connected by links of at least the
    similarity. text_id is the smallest id among copies, texts with the same words (equal texts, where there are no
    words). A null text is no copy of anything: its class is its own id; so is that of a null id, null. Texts shorter than five words are one shingle; very long
    ones are compared whole. Rows of a repeated id are one document, in the class of all its texts. An empty table gives an empty table.
    """
    ready = shared_table(prepare(docs, bands, rows, id_col, text_col))
    reps = cut(ready.groupBy("key").agg(F.min("id").alias("text_id"), F.count("*").alias("n")))
    members = shared_table(split_join(ready.select("id", "key"), reps.drop("n"), "key", "id", reps).groupBy("id").agg(F.min("text_id").alias("text_id"), F.max("text_id").alias("other")))
    nodes = members.where("id = text_id").select("id")
    # Where a repeated id has several texts, their nodes are one class.
    same = members.where("text_id != other").select(F.col("text_id").alias("a"), F.col("other").alias("b"))

    buckets = ready.join(nodes, "id", "left_semi").select("id", F.explode("keys").alias("band"))
    ends = cut(buckets.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).where("low < high"))
    met = shared_table(split_join(buckets, ends.drop("n"), "band", "id", ends))
    pair = lambda x, y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    tried = met.select(F.explode(F.array(pair("id", "low"), pair("id", "high"))).alias("p")).select("p.*").where("a != b").distinct()
    sets = ready.select("id", "shingles")
    links = cut(_verified(tried, sets, similarity))
    classes = components(cut(links.union(same)))

    # What the first links leave apart: texts of buckets that still hold several classes.
    known = met.select("band", "id").join(classes.withColumnRenamed("node", "id"), "id", "left").select("band", "id", F.coalesce("root", "id").alias("class"))
    split = known.groupBy("band").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.count("*").alias("n")).where("c0 < c1 and n > 2").select("band")
    apart = cut(known.join(split, "band", "left_semi").select("id", "class").distinct())
    if not apart.isEmpty():
        further = cut(_verified(prefix_pairs(sets, apart, similarity), sets, similarity))
        if not further.isEmpty():
            links = links.union(further).distinct()
            classes = components(cut(links.union(same)))

    found = members.select("id", "text_id").join(classes.select(F.col("node").alias("text_id"), "root"), "text_id", "left")
    found = found.select(F.col("id").alias("doc_id"), F.coalesce("root", "text_id").alias("class_id"), "text_id")
    alone = docs.where(F.col(id_col).isNull() | F.col(text_col).isNull()).select(F.col(id_col).cast("long").alias("doc_id"))
    alone = alone.distinct().join(found.select("doc_id"), "doc_id", "left_anti")
    return found.union(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id")))
