"""Document fingerprints by winnowing (operator 10).

Every k-gram of code points gets a rolling polynomial hash, scrambled so that minima are spread evenly. A text counts
as if k - 1 blanks that are no characters stood before and behind it, so a text of n code points has n + k - 1 grams,
whatever n. From each window of w hashes the smallest is chosen, the rightmost of equals; windows that overlap an end
of the text are windows too. A choice made again by the next window counts once. The rule is the same for all
lengths; any passage of w + k - 1 code points that two texts share gives both at least one equal hash. The position
of each chosen gram, that of its last code point, is kept.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

K, W = 8, 24
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20
_M64 = (1 << 64) - 1


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k code points, from runs of powers of two: hash(xy) = hash(x) * base^|y| + hash(y)."""
    n = len(points) - k + 1
    total, done, power = None, 0, points.astype(np.uint64) + np.uint64(1)
    size, base = 1, _BASE
    at = k
    while True:
        if at & 1:
            total = power[:n].copy() if total is None else total * np.uint64(base) + power[done : done + n]
            done += size
        at >>= 1
        if not at:
            break
        power = power[:-size] * np.uint64(base) + power[size:]
        size, base = 2 * size, base * base & _M64
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x94D049BB133111EB)
    return total >> np.uint64(32)


def choose(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions of the window minima, rightmost of equals, ascending; the first and last windows hold one hash."""
    n, found = len(hashes), []
    if n == 0:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << 31) - 1)
    beyond = np.full(w - 1, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, n + w - 1, _BLOCK):  # blocks bound the memory of very long texts
        left, right = max(a - w + 1, 0), min(a + _BLOCK, n)
        part = hashes[left:right]
        # The position counts downwards, so that the smallest key is the rightmost of equal hashes.
        low = (part << np.uint64(31)) | (mask - np.arange(len(part), dtype=np.uint64))
        low = np.concatenate([beyond[: max(w - 1 - a, 0)], low, beyond[: min(a + _BLOCK, n + w - 1) - right]])
        size = 1
        while 2 * size <= w:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < w:
            low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
        where = (mask - (low & mask)).astype(np.int64) + left
        found.append(where[np.r_[True, where[1:] != where[:-1]]])
    where = np.concatenate(found)
    return where[np.r_[True, where[1:] != where[:-1]]]


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions) of a text. An empty one has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = np.zeros(k - 1, np.uint64)
    hashes = gram_hashes(np.concatenate([blank, points.astype(np.uint64) + np.uint64(1), blank]), k)
    where = choose(hashes, w)
    return hashes[where], where


def fingerprint_text(hashes: np.ndarray, where: np.ndarray) -> str:
    """10 hex digits for each choice: its hash, and the step from the choice before (from 0 for the first)."""
    if not len(where):
        return ""
    out = np.empty((len(where), 5), np.uint8)
    out[:, :4] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    out[:, 4] = np.diff(where, prepend=0)  # at most the window
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted sets of hashes; two empty ones are alike, an empty and another are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many code points of the following text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


#: Rows in a range, the most ranges, and rows of the sample for each range. The driver and every task hold one key
#: for each range: at most 65,536, whatever the data.
RANGE_ROWS, RANGES, SAMPLED = 256, 65_536, 8
_KEY = "named, id, h"


def fingerprint(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, which borrows from the next text by id.

    Rows are ordered by id, null ids first, and equal ids by a hash of their texts, so that a repeated id does not
    make a large group. The order is cut into ranges at the quantiles of a bounded sample. Each range also gets the
    first row of the next one, so a single shuffle brings every text together with the text after it. The next of the
    last is the first.

    Null text counts as empty. A table of one row borrows from itself; an empty table gives an empty table. Very long
    texts are read whole, in blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(F.col("id").isNotNull().cast("int").alias("named"), F.coalesce("id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"), "text")
    keys = rows.select("named", "id", "h")
    n = keys.count()
    ranges = max(1, min(n // RANGE_ROWS, RANGES))
    share = min(1.0, SAMPLED * ranges / max(n, 1))
    sample = keys.where(F.xxhash64("h", "id") / 2.0**64 + 0.5 <= share).distinct().orderBy("named", "id", "h")
    found = [tuple(x) for x in zip(*(c.to_pylist() for c in sample.toArrow().columns))]
    cuts = [found[i * len(found) // ranges] for i in range(1, ranges)] if len(found) >= ranges else found
    shipped = spark.sparkContext.broadcast(cuts)
    numbered = keys.mapInArrow(_with_range(shipped), "range long, named int, id long, h long")
    first = {r["range"]: tuple(r["first"]) for r in numbered.groupBy("range").agg(F.min(F.struct("named", "id", "h")).alias("first")).collect()}
    order = sorted(first)
    # Of each range: its first key, and the range before it, which borrows that row.
    heads = spark.sparkContext.broadcast({r: (first[r], before) for r, before in zip(order, [*order[-1:], *order[:-1]])})
    placed = rows.mapInArrow(_with_borders(shipped, heads), "range long, border int, named int, id long, h long, text string")
    return (
        placed.repartitionByRange("range")
        .sortWithinPartitions("range", "border", "named", "id", "h", "text")
        .mapInArrow(_pairs(k, w, id_col), f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    )


def _numbers(batch: pa.RecordBatch, cuts: list) -> list[int]:
    """The range of each row: how many cuts are at or before its key."""
    return [bisect_right(cuts, key) for key in zip(*(batch.column(c).to_pylist() for c in range(3)))]


def _with_range(cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_numbers(batch, cuts.value), pa.int64()), *batch.columns], names=["range", "named", "id", "h"])

    return run


def _with_borders(cuts, heads):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = heads.value
        names = ["range", "border", "named", "id", "h", "text"]

        def out(ranges, border, part):
            return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), pa.array([border] * len(ranges), pa.int32()), *part.columns], names=names)

        for batch in batches:
            ranges = _numbers(batch, cuts.value)
            yield out(ranges, 0, batch)
            keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
            head = [j for j, (r, key) in enumerate(zip(ranges, keys)) if first[r][0] == key]
            if head:
                yield out([first[ranges[j]][1] for j in head], 1, batch.take(pa.array(head)))

    return run


def _pairs(k: int, w: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for the text after it: range, id, text, hashes, positions
        names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            out = []
            for number, border, named, i, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if border and (held is None or held[0] != number):
                    continue  # a further row with the border's key
                own = winnow(text, k, w)
                own_set = np.unique(own[0])
                if held is not None:
                    _, doc, before, (h, p), h_set = held
                    changed = edited(before, text)
                    ch, cp = winnow(changed, k, w)
                    out.append((doc, len(before), sha256(changed.encode()).hexdigest(), fingerprint_text(h, p), fingerprint_text(ch, cp), likeness(h_set, np.unique(ch)), likeness(h_set, own_set)))
                held = None if border else (number, i if named else None, text, own, own_set)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types, strict=True)], names=names)

    return run
