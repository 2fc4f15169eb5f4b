"""Toxicity by character n-grams, naive Bayes log-count ratios and logistic regression (operator 13).

A text is the set of its lower-cased runs of 3 to 6 characters. Over a bounded sample of labelled texts each n-gram has
a log-count ratio: how much larger its share is among toxic texts than among others. These ratios scale the features
of a linear classifier, so that it starts where naive Bayes ends. N-grams that are as common in both kinds, or rare,
have a ratio near 0, would weigh nothing, and are left out. The weights are the minimum of the regularised logistic
loss, whose gradient is summed over the partitions of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, map_columns, release, small_batches

#: Lengths of the n-grams; the most labelled rows used; texts that an n-gram must be in; its least log-count ratio; the
#: most n-grams kept (those with the largest ratios for their number).
SIZES, LABELLED, SEEN, RATIO, FEATURES = (3, 4, 5, 6), 20_000, 8, 1.0, 2048
#: Added to all counts; the weight of the squared weights; steps of the fit.
SMOOTH, RIDGE, STEPS = 1.0, 1e-3, 60
#: Parts of the sample: as many rows of sums reach the driver at each step.
PARTS = 8
#: N-grams that a task holds before it passes its numbers on; code points that are hashed at once.
HELD = 4_000_000
_BLOCK = 1 << 16
_GOLDEN, _C1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of a text framed by blanks, in blocks, repeats included. White space is a blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 0x21, 0x20, points).astype(np.uint64) * _GOLDEN
    longest = max(SIZES)
    for start in range(0, len(points), _BLOCK):
        block = points[start : start + _BLOCK + longest - 1]
        own = min(_BLOCK, len(points) - start)
        h = block.copy()
        for k in range(2, longest + 1):
            if len(block) < k:
                break
            h = h[: len(block) - k + 1] * _C1 + block[k - 1 :]
            if k in SIZES:
                x = h[:own] ^ (h[:own] >> np.uint64(31))
                yield (x * _GOLDEN) ^ np.uint64(k)


def grams(text: str) -> np.ndarray:
    """The distinct hashes of a text."""
    found = list(hashes(text))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


@dataclass
class Model:
    """Ascending hashes of the n-grams, their weights (ratio times coefficient), and the bias."""

    keys: np.ndarray
    weight: np.ndarray
    bias: float

    def finder(self):
        """A function from a text to the numbers of its features. A map of 2^20 bits settles most n-grams at once."""
        bits = np.zeros(1 << 20, bool)
        bits[self.keys >> np.uint64(44)] = True

        def find(text: str) -> np.ndarray:
            some = [h[bits[h >> np.uint64(44)]] for h in hashes(text)]
            some = np.unique(np.concatenate(some)) if some else np.zeros(0, np.uint64)
            if not len(some) or not len(self.keys):
                return np.zeros(0, np.int64)
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            return at[self.keys[at] == some]

        return find

    def scorer(self):
        find = self.finder()

        def score(text: str | None) -> float:
            z = self.bias + float(self.weight[find(text or "")].sum())
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text, y of at most about ``rows`` different labelled texts: those with the smallest hash of id and text. A
    text that repeats under its id counts once, labels that contradict each other as their mean."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("toxic").alias("y"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("doc_id", "text"))
    found = cut(texts.select("doc_id", "h").join(known, "doc_id").dropDuplicates(["doc_id", "h"]))
    n = found.count()
    share = min(1.0, rows / max(n, 1))
    chosen = found.where(F.xxhash64("h") / 2.0**64 + 0.5 <= share)
    # As many ids as rows, with a label each; their repeated texts are merged before the shuffle.
    return texts.join(F.broadcast(chosen.select("doc_id", "h", "y")), ["doc_id", "h"]).groupBy("doc_id", "h").agg(F.first("text").alias("text"), F.first("y").alias("y")).select("text", "y", "h")


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of a task's texts with the numbers of texts of both kinds."""
    held: list = []
    size = 0

    def out():
        h = np.concatenate([x for x, _ in held])
        y = np.repeat([y for _, y in held], [len(x) for x, _ in held])
        keys, at = np.unique(h, return_inverse=True)
        pos, every = np.bincount(at, y, len(keys)), np.bincount(at, minlength=len(keys))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pos), pa.array(every - pos)], names=["key", "pos", "neg"])

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.append((grams(text), y))
            size += len(held[-1][0])
            if size > HELD:
                yield out()
                held.clear()
                size = 0
    if held:
        yield out()
    held.clear()
    release()


def minimise(loss, size: int, steps: int = STEPS) -> np.ndarray:
    """L-BFGS from 0 with halved steps; ``loss(w)`` gives value and gradient."""
    w = np.zeros(size)
    value, g = loss(w)
    pairs: list = []
    for _ in range(steps):
        d, alphas = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ d) / (y @ s)
            alphas.append(a)
            d -= a * y
        if pairs:
            s, y = pairs[-1]
            d *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(alphas)):
            d += (a - (y @ d) / (y @ s)) * s
        step = 1.0 if pairs else 1.0 / max(np.abs(g).sum(), 1e-12)
        while step > 1e-8:
            new, new_g = loss(w - step * d)
            if new <= value - 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            return w
        s, y = -step * d, new_g - g
        w, done = w + s, value - new < 1e-7 * abs(value)
        value, g = new, new_g
        if s @ y > 1e-12:
            pairs = [*pairs[-9:], (s, y)]
        if done:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED) -> Model | None:
    """Fit on a bounded sample of labelled texts, ``rows`` of them at most or so. None without any labelled text."""
    spark = docs.sparkSession
    small_batches(spark)
    # The bound of the fit: its texts are read from the checkpoint by a fixed number of tasks.
    some = cut(sample(docs, labels, rows).select("text", "y", F.pmod("h", F.lit(PARTS)).alias("part")).repartition(PARTS, "part").select("text", "y"))
    n, n_pos = some.agg(F.count("*"), F.sum("y")).first()
    if not n:
        return None
    n_neg = n - n_pos
    tallies = some.mapInArrow(_tallied, "key long, pos double, neg double").groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= SEEN)
    ratio = F.log((F.col("pos") + SMOOTH) / (n_pos + 2 * SMOOTH)) - F.log((F.col("neg") + SMOOTH) / (n_neg + 2 * SMOOTH))
    found = tallies.withColumn("ratio", ratio).where(F.abs("ratio") >= RATIO)
    kept = found.orderBy((F.abs("ratio") * F.sqrt(F.col("pos") + F.col("neg"))).desc(), "key").limit(FEATURES).toArrow()
    keys, ratios = np.array(kept["key"].to_pylist(), np.int64).view(np.uint64), np.array(kept["ratio"].to_pylist(), float)
    order = np.argsort(keys)
    keys, ratios = keys[order], ratios[order]
    prior = float(np.log((n_pos + SMOOTH) / (n_neg + SMOOTH)))
    model = Model(keys, ratios, prior)
    shipped = spark.sparkContext.broadcast(model)

    def features():
        find = shipped.value.finder()
        return lambda texts, ys: [[find(t).tolist() for t in texts], ys]

    rows_ = cut(map_columns(some, ["text", "y"], "x array<int>, y double", features))
    size = len(keys) + 1

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, bias = w[:-1] * ratios, w[-1]

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, g, b = 0.0, np.zeros(size - 1), 0.0
            for batch in batches:
                x, y = batch.column(0), batch.column(1).to_numpy()
                at, ends = x.flatten().to_numpy(), np.diff(x.offsets.to_numpy())
                row = np.repeat(np.arange(len(y)), ends)
                z = np.bincount(row, scaled[at], len(y)) + bias
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                total += float((np.logaddexp(0, z) - y * z).sum())
                g += np.bincount(at, (p - y)[row], size - 1)
                b += float((p - y).sum())
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([b]), pa.array([g.tobytes()], pa.binary())], names=["total", "b", "g"])

        parts = rows_.mapInArrow(sums, "total double, b double, g binary").collect()
        g = sum(np.frombuffer(bytes(p["g"])) for p in parts)
        value = sum(p["total"] for p in parts) / n + RIDGE / 2 * float(w[:-1] @ w[:-1])
        return value, np.append(g * ratios / n + RIDGE * w[:-1], sum(p["b"] for p in parts) / n)

    w = minimise(loss, size)
    return Model(keys, w[:-1] * ratios, float(w[-1]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1), predicted (1 from 0.5 on) of every whole text. Without a model every score is 0."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = shipped.value.scorer() if shipped.value is not None else lambda t: 0.0

        def run(ids, texts):
            s = [of(t) for t in texts]
            return [ids, s, [int(x >= 0.5) for x in s]]

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, score double, predicted int", make)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """Learn from the labels outside the held-out fold and score every document: doc_id, held_out, score, predicted.

    Null text counts as empty and is scored as any other. Rows of a repeated doc_id are scored each by its own text.
    Null labels teach nothing; without any usable label every score is 0. An empty table gives an empty table. Texts
    of any length are read whole. Other columns are not read.
    """
    fold = crc_mod("doc_id", folds)
    model = fit(docs.where(fold != held_out_fold), labels)
    return score(docs, model).withColumn("held_out", F.coalesce(fold == held_out_fold, F.lit(False))).select("doc_id", "held_out", "score", "predicted")
