"""Quality scores by random Fourier features, ridge regression and isotonic calibration (operator 9).

Each document becomes a vector of statistics of its whole text. Random Fourier features approximate a Gaussian
kernel over these. Every partition of the training rows sums its normal equations; their total gives the ridge
weights. A part of the training rows, kept out of the fit, calibrates the raw scores by isotonic regression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, map_columns

#: Fourier features, kernel width in standard deviations for each statistic, ridge, and the most labelled rows used.
FEATURES, WIDTH, RIDGE, LABELLED = 384, 1.0, 1e-3, 20_000
_PARTS = 8
#: The most ids that are broadcast (16 bytes each, with their label).
BROADCAST_IDS = 1_000_000
_SEED = 7

_LETTER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _COMMA, _SYMBOL, _OTHER = range(9)


def _classes() -> np.ndarray:
    kind = np.full(0x300, _OTHER, np.uint8)
    for c in range(0x300):
        x = chr(c)
        if x == "\n":
            kind[c] = _LINE
        elif x.isspace():
            kind[c] = _SPACE
        elif x.isupper():
            kind[c] = _UPPER
        elif x.isalpha():
            kind[c] = _LETTER
        elif x.isdigit():
            kind[c] = _DIGIT
        elif x in ".!?":
            kind[c] = _STOP
        elif x in ",;:'\"-()":
            kind[c] = _COMMA
        elif x.isprintable():
            kind[c] = _SYMBOL
    return kind


_KIND = _classes()
N_STATISTICS = 24


def statistics(text: str) -> list[float]:
    """N_STATISTICS figures of a text, all finite; those of an empty text are 0."""
    n = len(text)
    if not n:
        return [0.0] * N_STATISTICS
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(points, 0x2FF)
    share = np.bincount(_KIND[small], minlength=9) / n
    letters = np.bincount(small & 0x7F, minlength=128) / n
    entropy = -float((letters[letters > 0] * np.log(letters[letters > 0])).sum())
    words = text.split()
    w = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    tally = Counter(words)
    lines = [x for x in text.split("\n") if x]
    many = max(len(lines), 1)
    distinct = len(set(lines))
    top = max(tally.values(), default=0) / w
    ends = sum(1 for x in lines if x[-1] in ".!?") / many
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), *share.tolist(), entropy,
        float(sizes.mean()), float(np.log1p(sizes.std())), float(np.log1p(sizes.max())), float((sizes <= 3).mean()), float((sizes >= 16).mean()),
        len(tally) / w, top, float(np.log1p(len(lines))), float(np.log1p(n / many)), distinct / many, ends,
        share[_STOP] / (share[_STOP] + share[_COMMA] + 1e-9),
    ]


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points (mean score, share of label 1), both ascending."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, y in zip(score[order], label[order]):
        blocks.append([1.0, s, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            n, s_, y_ = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + s_, blocks[-1][2] + y_]
    n, s, y = np.array(blocks).T
    return s / n, y / n


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    at: np.ndarray
    share: np.ndarray

    @staticmethod
    def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(_SEED)
        z = np.clip((x - mean) / scale, -6, 6)
        w = rng.standard_normal((x.shape[1], FEATURES)) / (WIDTH * np.sqrt(x.shape[1]))
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x, self.mean, self.scale) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.share), 0.0, 1.0)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the statistics of every whole text (null: empty)."""

    def make():
        return lambda ids, texts: [ids, [statistics(t or "") for t in texts]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, x array<double>", make)


def labelled(docs: DataFrame, known: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """doc_id and text of that share of the labelled documents, and doc_id and y of these. So few ids are broadcast, and
    no text is shuffled to find those of the sample."""
    chosen = F.xxhash64("doc_id") / 2.0**64 + 0.5 <= share
    ids = cut(known.where(chosen).join(docs.where(chosen).select("doc_id"), "doc_id", "left_semi"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.where(chosen).select("doc_id", "text").join(ids.select("doc_id"), "doc_id", "left_semi"), ids


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED) -> Model | None:
    """Fit on at most about ``rows`` labelled documents, those with the smallest hash of their id: the bound of the
    fit, whatever the data. Labels that contradict each other count as their mean. None without labels."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    n = docs.select("doc_id").join(known, "doc_id").count()
    if not n:
        return None
    some, ids = labelled(docs, known, rows / n)
    # Of a bounded number of rows: one line of sums for each of a fixed number of parts.
    sample = cut(document_statistics(some).join(ids, "doc_id").select("x", "y", "doc_id").repartition(_PARTS))
    sums = sample.select(F.posexplode("x")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_pop("col").alias("s")).orderBy("pos").collect()
    mean, scale = np.array([r["m"] for r in sums]), np.maximum(np.array([r["s"] for r in sums]), 1e-6)

    def equations(batches):
        size = FEATURES + 1
        a, b, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            x, y = np.array(batch.column(0).to_pylist()), np.array(batch.column(1).to_pylist(), float)
            if len(x):
                f = Model.features(x, mean, scale)
                a, b, n = a + f.T @ f, b + f.T @ y, n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()]), pa.array([n])], names=["a", "b", "n"])

    calibrates = crc_mod("doc_id", 16) < 4
    parts = sample.where(~calibrates).select("x", "y").mapInArrow(equations, "a binary, b binary, n long").collect()
    size = FEATURES + 1
    a = sum(np.frombuffer(bytes(p["a"])).reshape(size, size) for p in parts)
    b = sum(np.frombuffer(bytes(p["b"])) for p in parts)
    count = sum(p["n"] for p in parts)
    weight = np.linalg.solve(a + max(count, 1) * RIDGE / FEATURES * np.eye(size), b)
    model = Model(mean, scale, weight, np.zeros(1), np.full(1, 0.5))
    held = sample.where(calibrates).select("x", "y").collect() or sample.select("x", "y").collect()
    x, y = np.array([r["x"] for r in held]), np.array([r["y"] for r in held], float)
    model.at, model.share = isotonic(model.raw(x), y)
    return model


def scorer(model: Model | None):
    """A function from texts to scores, for use within tasks. Without a model every score is 0.5."""

    def run(texts: list) -> np.ndarray:
        if model is None or not texts:
            return np.full(len(texts), 0.5)
        return model.score(np.array([statistics(t or "") for t in texts]))

    return run


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1), predicted (1 from 0.5 on)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = scorer(shipped.value)

        def run(ids, texts):
            s = of(texts)
            return [ids, s.tolist(), (s >= 0.5).astype(int).tolist()]

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, score double, predicted int", make)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out_fold: int = 1) -> DataFrame:
    """Learn from the labels outside the held-out fold and score every document: doc_id, held_out, score, predicted.

    Null text counts as empty and is scored as any other. Rows of a repeated doc_id are scored each by its own
    text. Null labels teach nothing; without any usable label every score is 0.5. An empty table gives an empty
    table.
    """
    fold = crc_mod("doc_id", folds)
    model = fit(docs.where(fold != held_out_fold), labels)
    return score(docs, model).withColumn("held_out", F.coalesce(fold == held_out_fold, F.lit(False))).select("doc_id", "held_out", "score", "predicted")
