"""Language-model scores by masked pseudo-likelihood (operator 1).

The tokens are words. Each is predicted from the two words before and the two words after it. A small window network
gives the class of the word by a two-level softmax: the most frequent words are classes of their own, the others share
classes by their endings. A word's probability is that of its class given the words around it times its share of the
class's words in the whole corpus; the probabilities of all words sum to one. The summed log probabilities of its
words score a document.

Documents are encoded once, in chunks of half a million words: the distinct words of a chunk as 64-bit hashes, and the
places of its words among them. How often each word occurs is counted over all chunks by a shuffle of what is distinct
within a chunk, and the counts go back to the chunks in the order of their words; the table of words grows with the
corpus. The network is warmed up on a bounded sample; then every partition goes on from there over all its words, and
the partitions' parameters are averaged, weighted by their words, in two summing steps. What is broadcast (the frequent
words, the totals of the classes and one network) has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerations, cut, release, shared_table, small_batches

#: Frequent words that are classes of their own; the others share as many classes by a hash of their endings, which is
#: in the lowest bits of a word's hash.
FREQUENT, HASHED = 512, 512
CLASS = 32  # outputs in a group of the two-level softmax
CLASSES = (FREQUENT + HASHED) // CLASS
HIDDEN, OFFSETS, MINIBATCH, RATE = 16, (-2, -1, 1, 2), 8192, 0.08
PAD = FREQUENT + HASHED
#: Words in a chunk, chunks in an Arrow batch, and words (not their repeats in a chunk) counted by one task.
CHUNK, CHUNKS_IN_BATCH, COUNTED = 1 << 19, 4, 1 << 21
#: Documents of the warm-up: those with the smallest hash of their id.
WARM_DOCUMENTS = 400
_EDGE = max(OFFSETS)


class Network:
    SHAPES = (
        ("p", (len(OFFSETS), PAD + 1, HIDDEN)), ("b", (HIDDEN,)), ("c", (HIDDEN, CLASSES)), ("cb", (CLASSES,)),
        ("u", (CLASSES, HIDDEN, CLASS)), ("ub", (CLASSES, CLASS)),
    )
    SIZE = sum(int(np.prod(s)) for _, s in SHAPES)

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            flat = np.random.default_rng(11).normal(0, 0.1, self.SIZE)
        self.flat = np.array(flat, np.float32)
        self.views = self._cut(self.flat)

    @classmethod
    def _cut(cls, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in cls.SHAPES:
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def run(self, around: list[np.ndarray], target: np.ndarray, gradient: bool = False):
        """Log probability of each target word, and with ``gradient`` that of the mean negative log probability."""
        v = self.views
        h = v["b"] + sum(v["p"][o][x] for o, x in enumerate(around))
        h = np.tanh(h)
        group, place = target // CLASS, target % CLASS
        rows = np.arange(len(target))
        z = h @ v["c"] + v["cb"]
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        total = e.sum(axis=1)
        log_p = z[rows, group] - np.log(total)
        order = np.argsort(group.astype(np.int16), kind="stable")
        stops = np.cumsum(np.bincount(group, minlength=CLASSES))
        if gradient:
            grad = np.zeros(self.SIZE, np.float32)
            g = self._cut(grad)
            d = e / total[:, None]
            d[rows, group] -= 1
            d /= len(target)
            g["c"][:], g["cb"][:] = h.T @ d, d.sum(axis=0)
            dh = d @ v["c"].T
        start = 0
        for k, stop in enumerate(stops):
            own = order[start:stop]
            start = stop
            if not len(own):
                continue
            hk, pk = h[own], place[own]
            z = hk @ v["u"][k] + v["ub"][k]
            z -= z.max(axis=1, keepdims=True)
            e = np.exp(z)
            total = e.sum(axis=1)
            log_p[own] += z[np.arange(len(own)), pk] - np.log(total)
            if gradient:
                d = e / total[:, None]
                d[np.arange(len(own)), pk] -= 1
                d /= len(target)
                g["u"][k], g["ub"][k] = hk.T @ d, d.sum(axis=0)
                dh[own] += d @ v["u"][k].T
        if not gradient:
            return log_p
        dh *= 1 - h * h
        g["b"][:] = dh.sum(axis=0)
        for o, x in enumerate(around):
            for j in range(HIDDEN):
                g["p"][o, :, j] = np.bincount(x, dh[:, j], minlength=PAD + 1)
        return log_p, grad


def laid(tokens: np.ndarray, sizes: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents laid end to end with padding around each: the line, and the places of their words in it."""
    at = np.arange(len(tokens)) + _EDGE * (1 + np.repeat(np.arange(len(sizes)), sizes))
    line = np.full(len(tokens) + _EDGE * (len(sizes) + 1), pad, tokens.dtype)
    line[at] = tokens
    return line, at


def windows(tokens: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Classes around each place and the class in it, so many at once that memory does not grow with a text."""
    line, at = laid(tokens, sizes, PAD)
    for a in range(0, len(at), MINIBATCH):
        part = at[a : a + MINIBATCH]
        yield [line[part + o].astype(np.int64) for o in OFFSETS], line[part].astype(np.int64)


def train(network: Network, chunks: Iterator[tuple[np.ndarray, np.ndarray]], rate: float = RATE) -> int:
    """One pass of Adagrad over (classes, sizes of documents); the number of words seen."""
    seen, square = 0, np.full(Network.SIZE, 1e-6, np.float32)
    for tokens, sizes in chunks:
        for around, target in windows(tokens, sizes):
            _, g = network.run(around, target, gradient=True)
            square += g * g
            network.flat -= rate * g / np.sqrt(square)
            seen += len(target)
    return seen


# -- words


def hash_of(word: str) -> int:
    """A word's 64-bit hash: 55 bits of the word, then the class of its ending. Of a hundred million words a tenth of a
    pair is expected to share one."""
    ending = crc32(word[-3:].encode("utf-8", "surrogatepass")) % HASHED
    return int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") // HASHED * HASHED | ending


def encode(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """chunk, ids, sizes, words, places, n, distinct: whole documents in chunks. Words are what white space parts, in
    lower case; a null text has none."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TwoGenerations(hash_of).__getitem__
        base, made, held, ids, id_type = TaskContext.get().partitionId() << 32, 0, [], [], None

        def out():
            nonlocal made, held, ids
            words, places = np.unique(np.concatenate(held), return_inverse=True)
            row = [[base + made], [ids], [np.fromiter(map(len, held), np.int64, len(held)).tobytes()], [words.tobytes()], [_packed(places.ravel(), len(words))], [len(places)], [len(words)]]
            made, held, ids = made + 1, [], []
            types = [pa.int64(), pa.list_(id_type), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["chunk", "ids", "sizes", "words", "places", "n", "distinct"])

        words = 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = (t or "").lower().split()
                held.append(np.fromiter(map(number, ws), np.uint64, len(ws)))
                ids.append(i)
                words += len(ws) + 1
                if words >= CHUNK:
                    yield out()
                    words = 0
        if ids:
            yield out()
        release()

    small_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(run, f"chunk long, ids array<{kind}>, sizes binary, words binary, places binary, n long, distinct long")


def _packed(places: np.ndarray, distinct: int) -> bytes:
    """Places of 3 bytes each, of 8 where so many words are different."""
    if distinct >> 24:
        return places.astype("<i8").tobytes()
    return places.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(data, distinct: int) -> np.ndarray:
    if distinct >> 24:
        return np.frombuffer(data, "<i8")
    raw = np.frombuffer(data, np.uint8).reshape(-1, 3)
    places = np.zeros((len(raw), 4), np.uint8)
    places[:, :3] = raw
    return places.view("<i4").ravel()


def classes_of(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The class of each word; ``frequent`` is sorted."""
    out = (FREQUENT + (words & np.uint64(HASHED - 1)).astype(np.int64)).astype(np.int16)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        hit = frequent[at] == words
        out[hit] = at[hit]
    return out


# -- what the corpus gives


def part_bits(encoded: DataFrame) -> int:
    """The words are counted in two to the power of so many parts, by the first bits of their hashes."""
    return max(0, ((encoded.agg(F.sum("distinct")).first()[0] or 0) // COUNTED).bit_length())


def word_counts(encoded: DataFrame, bits: int) -> DataFrame:
    """chunk, part, counts: how often the words of the chunk that belong to the part occur in the corpus, in their
    order (64-bit); and for each part a row without a chunk, with its most frequent words (top, of which no more than
    FREQUENT can matter), their numbers, and the sums of its words by ending."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = np.frombuffer(batch.column(1)[k].as_buffer(), np.uint64)
                if not len(words):
                    continue
                n = np.bincount(_unpacked(batch.column(2)[k].as_buffer(), len(words)), minlength=len(words)).astype(np.int32)
                part = (words >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
                used, first = np.unique(part, return_index=True)
                edges = [*first.tolist(), len(words)]
                rows = [(words[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([batch.column(0)[k].as_py()] * len(used), pa.int64()), *(pa.array(c, pa.binary()) for c in zip(*rows))], names=["part", "chunk", "words", "times"])
        release()

    names = ["chunk", "part", "counts", "top", "times", "endings"]

    def counted(part: int, chunks: list, words: list, times: list) -> Iterator[pa.RecordBatch]:
        line = np.concatenate(words)
        distinct, at = np.unique(line, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at.ravel(), np.concatenate(times))
        edge = 0
        for chunk, own in zip(chunks, words):
            counts = total[at[edge : edge + len(own)]]
            edge += len(own)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([part], pa.int64()), pa.array([counts.tobytes()], pa.binary()), *[pa.nulls(1, pa.binary())] * 3], names=names)
        top = np.lexsort((distinct, -total))[:FREQUENT]
        endings = np.zeros(HASHED, np.int64)
        np.add.at(endings, (distinct & np.uint64(HASHED - 1)).astype(np.int64), total)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([part], pa.int64()), pa.nulls(1, pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in (distinct[top], total[top], endings))], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            for part, chunk, words, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if part != now and held[0]:
                    yield from counted(now, *held)
                    held = ([], [], [])
                now = part
                held[0].append(chunk)
                held[1].append(np.frombuffer(words.as_buffer(), np.uint64))
                held[2].append(np.frombuffer(times.as_buffer(), np.int32))
        if held[0]:
            yield from counted(now, *held)
        held = None
        release()

    small_batches(encoded.sparkSession, CHUNKS_IN_BATCH)
    dealt = encoded.select("chunk", "words", "places").mapInArrow(deal, "part long, chunk long, words binary, times binary")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(count, "chunk long, part long, counts binary, top binary, times binary, endings binary")


def output_layer(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent words (sorted hashes, at most FREQUENT), and how many words each class has. Every part gives at
    most FREQUENT words and HASHED sums, which Spark puts together before the driver sees FREQUENT + HASHED rows."""
    parts = counts.where("chunk is null").select("top", "times", "endings")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                top, times, endings = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in range(3))
                kind = np.repeat([0, 1], [len(top), HASHED])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([top, np.arange(HASHED)])), pa.array(np.concatenate([times, endings]))], names=["kind", "key", "n"])

    rows = parts.mapInArrow(listed, "kind long, key long, n long")
    # Hashes are compared as unsigned numbers, so that a tie has one answer however the words are dealt.
    top = rows.where("kind = 0").orderBy(F.desc("n"), F.col("key").bitwiseXOR(F.lit(-(1 << 63)))).limit(FREQUENT).collect()
    endings = {r["key"]: r["n"] for r in rows.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    n = dict(zip(np.array([r["key"] for r in top], np.int64).view(np.uint64).tolist(), (r["n"] for r in top)))
    frequent = np.array(sorted(n), np.uint64)
    total = np.zeros(PAD, np.int64)
    for k, h in enumerate(frequent.tolist()):
        total[k] = n[h]
    for e in range(HASHED):
        total[FREQUENT + e] = endings.get(e, 0) - sum(m for h, m in n.items() if h % HASHED == e)
    return frequent, total


def _summed(parts: DataFrame) -> tuple[int, np.ndarray]:
    """The words and the weighted sum of all partitions' parameters, added up in two steps, one vector at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = 0, np.zeros(Network.SIZE)
        for batch in batches:
            for n, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                seen, total = seen + n, total + np.frombuffer(x.as_buffer(), np.float64)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "seen", "flat"])

    rows = parts.repartition(64, "part").mapInArrow(add, "part long, seen long, flat binary").collect()  # at most 64 vectors
    return sum(r["seen"] for r in rows), sum((np.frombuffer(bytes(r["flat"])) for r in rows), np.zeros(Network.SIZE))


def fit(encoded: DataFrame, frequent) -> Network:
    """Warm up on a bounded sample, then average one pass of every partition over all its documents. ``frequent`` are
    the broadcast frequent words."""
    spark = encoded.sparkSession
    ids = encoded.select("chunk", F.posexplode("ids").alias("pos", "id"))
    # A document's place in its chunk; those with the smallest hashes warm the network up.
    warm = cut(ids.select("chunk", "pos", F.xxhash64("id", "chunk", "pos").alias("h")).orderBy("h").limit(WARM_DOCUMENTS))
    chosen = warm.groupBy("chunk").agg(F.collect_list("pos").alias("chosen"))

    def passes(flat, few: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            network = Network(flat.value)

            def chunks():
                for batch in batches:
                    for k in range(batch.num_rows):
                        tokens, sizes = _classes(batch, k, frequent.value)
                        if few:
                            wanted = np.zeros(len(sizes), bool)
                            wanted[batch.column(batch.num_columns - 1)[k].as_py()] = True
                            tokens, sizes = tokens[np.repeat(wanted, sizes)], sizes[wanted]
                        if len(tokens):
                            yield tokens, sizes

            seen = train(network, chunks())
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 64], pa.int64()), pa.array([seen], pa.int64()), pa.array([(network.flat.astype(np.float64) * seen).tobytes()], pa.binary())], names=["part", "seen", "flat"])
            release()

        return run

    columns, kind = ["sizes", "words", "places"], "part long, seen long, flat binary"
    start = spark.sparkContext.broadcast(Network().flat)
    small_batches(spark, CHUNKS_IN_BATCH)
    # At most WARM_DOCUMENTS chunks, of which only the chosen documents go on to the one task.
    first = encoded.join(F.broadcast(chosen), "chunk").select(*columns, "chosen").mapInArrow(passes(start, True), kind)
    seen, total = _summed(first)
    if not seen:
        return Network()
    warmed = spark.sparkContext.broadcast((total / seen).astype(np.float32))
    seen, total = _summed(encoded.select(*columns).mapInArrow(passes(warmed, False), kind))
    return Network((total / seen).astype(np.float32))


def _classes(batch: pa.RecordBatch, k: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all words of a row (sizes, words, places), and its sizes."""
    words = np.frombuffer(batch.column(1)[k].as_buffer(), np.uint64)
    return classes_of(words, frequent)[_unpacked(batch.column(2)[k].as_buffer(), len(words))], np.frombuffer(batch.column(0)[k].as_buffer(), np.int64)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, pll (summed log probability of every word given its neighbours), mean_pll.

    A null or empty text, or one of white space, has no words and scores 0. Repeated rows are trained on, counted and
    scored each; an empty table gives an empty table; very long texts are scored whole, in slices, and a text is in one
    chunk, so that a task holds 11 bytes for each word of the longest; other columns are not read.
    """
    spark = docs.sparkSession
    encoded = shared_table(encode(docs, id_col, text_col))
    bits = part_bits(encoded)
    counts = shared_table(word_counts(encoded, bits))
    frequent, total = (spark.sparkContext.broadcast(x) for x in output_layer(counts))
    flat = spark.sparkContext.broadcast(fit(encoded, frequent).flat)
    names = ["chunk", "kind", "part", "counts", "sizes", "words", "places", "ids"]
    kinds = dict(encoded.dtypes) | {"part": "long", "counts": "binary"}
    full = lambda df, kind: df.withColumn("kind", F.lit(kind)).select(*[F.col(c) if c in df.columns or c == "kind" else F.lit(None).cast(kinds[c]).alias(c) for c in names])
    # To each chunk come the counts of its words, part by part, then its documents.
    met = full(counts.where("chunk is not null").select("chunk", "part", "counts"), 1).union(full(encoded.select("chunk", "ids", "sizes", "words", "places"), 2))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, held = Network(flat.value), []
        for batch in batches:
            for k, kind in enumerate(batch.column(1).to_pylist()):
                if kind == 1:
                    held.append(np.frombuffer(batch.column(3)[k].as_buffer(), np.int64))
                    continue
                words = np.frombuffer(batch.column(5)[k].as_buffer(), np.uint64)
                sizes, places = np.frombuffer(batch.column(4)[k].as_buffer(), np.int64), _unpacked(batch.column(6)[k].as_buffer(), len(words))
                classes = classes_of(words, frequent.value)
                own = np.concatenate(held) if held else np.zeros(0, np.int64)
                shares = np.log(own / total.value[classes]) if len(own) else np.zeros(0)
                held = []
                log_p = np.concatenate([network.run(around, target).astype(np.float64) for around, target in windows(classes[places], sizes)] or [np.zeros(0)]) + shares[places]
                summed = np.concatenate([[0.0], np.cumsum(log_p)])
                stops = np.cumsum(sizes)
                pll = np.where(sizes > 0, summed[stops] - summed[stops - sizes], 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(7)[k].values, pa.array(sizes), pa.array(pll), pa.array(pll / np.maximum(sizes, 1))], names=[id_col, "n_tokens", "pll", "mean_pll"])
        release()

    small_batches(spark, CHUNKS_IN_BATCH)
    return met.repartition("chunk").sortWithinPartitions("chunk", "kind", "part").mapInArrow(run, f"{id_col} {id_type}, n_tokens long, pll double, mean_pll double")
