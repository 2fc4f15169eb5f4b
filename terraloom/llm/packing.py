"""Packing into fixed windows by Karmarkar-Karp multiway differencing (operator 2).

Documents longer than a window give full windows and a rest; rests longer than ``PIECE``, a quarter of
a window, are cut into pieces of that size and a last shorter one, the others stay whole. The pieces of a group are spread over k windows by differencing alone: each piece
starts as a partition of its own into k subsets; again and again the two partitions with the largest imbalance are
merged, the fullest subset of one with the emptiest of the other, until one partition is left, whose k sums are
nearly equal. k begins at the fewest windows that could hold the tokens; whenever a subset exceeds the capacity, k
rises by one and the group is differenced anew. Nothing is cut or moved afterwards.

Each input split packs its own whole groups. What is left of a split, less than a group, is only described by its
pieces' lengths; the leftovers of all splits are packed together, so that few windows stay part-filled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from .bpe import _ODD_SPACE, Shipped, bpe_of, count_words, split_white
from .common import release, shared_table, small_batches

WINDOW = 2048
#: Windows that are packed together, the share of their room that a group leaves to the imbalance of its subsets, and
#: the most tokens of a piece that is not a window of its own.
GROUP_WINDOWS, SLACK, PIECE = 128, 0.005, 512
#: Groups of leftovers in a task of the second step.
TAIL_GROUPS = 8
#: Chunks whose ids a worker remembers, in each of two generations (about 200 bytes each).
CACHE = 200_000
#: Bytes of text that are encoded at once.
MERGED = 8 << 20
#: Marks that no pattern of the vocabulary joins with letters.
_MARKS = ".,;:!?"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: indexes of ``sizes`` in k subsets with nearly equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A partition holds only its non-empty subsets, as (sum, members), largest first; the others are 0.
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # The fullest of one meet the emptiest of the other: empty ones cost nothing.
        free = k - len(a)
        alone, paired = b[:free], b[free:]
        joined = a[: len(a) - len(paired)] + alone
        for (sa, ma), (sb, mb) in zip(a[len(a) - len(paired) :], reversed(paired)):
            joined.append((sa + sb, ma + mb))
        joined.sort(key=lambda x: -x[0])
        least = joined[-1][0] if len(joined) == k else 0
        heapq.heappush(heap, (least - joined[0][0], count, joined))
        count += 1
    out = [m for _, m in heap[0][2]] if heap else []
    return out + [[] for _ in range(k - len(out))]


def pack_group(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """The subsets of indexes, each of at most the capacity, that differencing gives for the smallest k it can."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def cut_rest(start: int, length: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of pieces of ``longest`` tokens and a last shorter one. The many sizes of the last ones are what
    lets differencing even the sums out."""
    return [(a, min(longest, start + length - a)) for a in range(start, start + length, longest)]


class Groups:
    """Collects pieces (id, start, length, ids_crc32, doc_tokens, slot) and lays whole groups into windows."""

    def __init__(self, capacity: int, windows: int, base: int):
        self.capacity, self.most, self.base = capacity, int(windows * capacity * (1 - SLACK)), base
        self.sequence, self.waiting, self.held, self.rows = 0, 0, [], []

    def window(self, piece: tuple) -> None:
        """A piece that fills a window."""
        self.rows.append((*piece, self.base + self.sequence, 0))
        self.sequence += 1

    def add(self, piece: tuple) -> None:
        if self.waiting + piece[2] > self.most:
            self.flush()
        self.held.append(piece)
        self.waiting += piece[2]

    def flush(self) -> None:
        for window in pack_group([p[2] for p in self.held], self.capacity) if self.held else ():
            offset = 0
            for i in window:
                self.rows.append((*self.held[i], self.base + self.sequence, offset))
                offset += self.held[i][2]
            self.sequence += 1
        self.held, self.waiting = [], 0

    def leave(self) -> None:
        """The pieces of the unfinished group, without a place."""
        self.rows += [(*p, None, None) for p in self.held]
        self.held, self.waiting = [], 0

    def take(self, kinds: list, names: list[str]) -> pa.RecordBatch:
        columns = [pa.array(c, type=t) for c, t in zip(zip(*self.rows), kinds, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names=names)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, remembered: int = CACHE):
    """A function from a batch of texts to their ids end to end, and where each text's ids begin and end. Each distinct
    chunk (run without white space) of a batch is encoded once, and chunks seen lately are remembered. Those that are
    new go to the library as one text; each of its words ends with one word-final token, so the chunks' numbers of
    words tell where each chunk's ids end. A worker's later tasks go on with what it remembers."""
    lib = Tokenizer.from_str(vocabulary)
    known: dict[str, bytes] = {"": b""}
    older: dict[str, bytes] = {}
    final = np.zeros(lib.get_vocab_size(), bool)
    final[[i for t, i in lib.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True

    def learn(chunks: list[str]) -> None:
        plain, words, joined, asked = [], [], [], set()
        for c in chunks:
            low = c.lower() if c.isascii() else c
            body = low.rstrip(_MARKS)
            if body.isalpha() and (c.isascii() or body.lower().isalpha() and is_normalized("NFC", c)):
                # A word, perhaps with capitals or marks behind it: these are words of their own. (The dot of a
                # lowered capital I with a dot is no letter and would join the marks.)
                parts = (body, low[len(body) :])
                joined.append((c, *parts))
                for w in parts:
                    if w not in known and w not in asked:
                        asked.add(w)
                        if (blob := older.get(w)) is None:
                            plain.append(w)
                            words.append(1)
                        else:
                            known[w] = blob
            elif "<|" in c or not c.isprintable() or not is_normalized("NFC", c):
                known[c] = np.array(bpe_of(vocabulary).encode_chunk(c), "<u4").tobytes()
            else:
                plain.append(c)
                words.append(count_words(c))
        send(plain, words)
        for c, body, marks in joined:
            known[c] = known[body] + known[marks]

    def send(plain: list[str], words: list[int]) -> None:
        if plain:
            ids = np.array(lib.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(final[ids]) + 1
            if len(ends) != sum(words):
                known.update((c, np.array(bpe_of(vocabulary).encode_chunk(c), "<u4").tobytes()) for c in plain)
                return
            at, blob = 0, ids.tobytes()
            for c, stop in zip(plain, (4 * ends[np.cumsum(words) - 1]).tolist()):
                known[c] = blob[at:stop]
                at = stop

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        nonlocal known, older
        if len(known) > remembered:
            known, older = {"": b""}, known
        texts = texts.fill_null("")
        if pc.any(pc.match_substring_regex(texts, _ODD_SPACE.pattern)).as_py():
            chunks = pa.array([split_white(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            chunks = pc.utf8_split_whitespace(texts)
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        blobs = list(map(known.get, distinct))
        if None in blobs:
            new = []
            for c, blob in zip(distinct, blobs):
                if blob is None:
                    if (blob := older.get(c)) is None:
                        new.append(c)
                    else:
                        known[c] = blob
            learn(new)
            blobs = list(map(known.__getitem__, distinct))
        # The distinct chunks' ids end to end, gathered in the order of the texts.
        ids = np.frombuffer(b"".join(blobs), "<u4")
        size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        at = np.cumsum(size) - size
        where = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[where]
        stops = np.cumsum(sizes)
        out = ids[np.repeat(at[where] - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)]
        edges = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
        return out, np.concatenate([[0], stops])[edges]

    return encode


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least so many bytes: the more texts at once, the fewer distinct chunks to look up."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pack(docs: DataFrame, vocabulary: str, capacity: int = WINDOW, windows: int = GROUP_WINDOWS, piece: int = PIECE, end_id: int = 1, remembered: int = CACHE, merged: int = MERGED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document's ids and ``end_id`` into sequences of at most ``capacity`` tokens.

    One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Each task packs the groups of
    its own input split; only the description of the leftovers (less than ``windows`` windows a split, 50 bytes a
    piece) is shuffled, to tasks of a bounded number of tokens. Memory does not grow with the data. sequence_id is a
    task's number and a running number within it. A null text counts as empty and gives the end id alone, as does a
    null id's; repeated rows are packed each for itself; a very long text gives full windows and a rest; an empty
    table gives an empty table; other columns are not read. ``remembered`` and ``merged`` trade a worker's memory for
    time and change no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shipped = Shipped(spark, vocabulary)
    piece = min(piece, capacity)
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "slot", "sequence_id", "offset"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, slot long, sequence_id long, offset long"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        end = end_id.to_bytes(4, "little")
        encode = _encoder(shipped.text, remembered)
        groups, slot, kinds = Groups(capacity, windows, base), base, None
        for batch in _merged(batches, merged):
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 7]
            coded, edges = encode(batch.column(1))
            for k, doc in enumerate(batch.column(0).to_pylist()):
                ids = coded[edges[k] : edges[k + 1]].tobytes() + end
                n = len(ids) // 4
                whole = n - n % capacity
                for start, length in [(a, capacity) for a in range(0, whole, capacity)] + cut_rest(whole, n - whole, piece):
                    part = (doc, start, length, crc32(ids[4 * start : 4 * (start + length)]), n, slot)
                    slot += 1
                    (groups.window if length == capacity else groups.add)(part)
            if groups.rows:
                yield groups.take(kinds, names)
        groups.leave()
        if groups.rows:
            yield groups.take(kinds, names)
        release()

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        groups, kinds = Groups(capacity, windows, (1 << 22 | TaskContext.get().partitionId()) << 40), None
        for batch in batches:
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 7]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                groups.add(row)
            if groups.rows:
                yield groups.take(kinds, names)
        groups.flush()
        if groups.rows:
            yield groups.take(kinds, names)

    pieces = shared_table(docs.select(id_col, text_col).mapInArrow(own, schema))
    tail = pieces.where("sequence_id is null").drop("sequence_id", "offset")
    tokens = tail.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-tokens // (TAIL_GROUPS * windows * capacity)))
    # The slot is a number of its own for each piece, so no document or id can make a part large.
    packed = tail.repartition(parts, "slot").sortWithinPartitions("slot").mapInArrow(left, schema)
    return pieces.where("sequence_id is not null").union(packed).drop("slot")
