"""Spelling variants by halves of words in Aho-Corasick automata (operator 11).

Two words one edit apart share a half: the edit touches only one of the two segments of either word, so that the other
one stands unchanged at the front or at the end of the other word. Automata hold the two segments of every word. All
words are scanned; a hit counts if it lies where its segment has to lie (the front or the end) and if the lengths of
the words differ by one at most. The rests of the two words are then verified.

The automata are dealt out in shards by the hash of the segment. A word can only hit segments that are one of its own
four prefixes and suffixes of fitting length, so it is scanned by the at most four shards that may hold these, and the
work grows with the number of words. A segment of very many words is split over several shards. A scan gives one row for each word and
shard, with the number of near words and the best of them, never the pairs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release, shared_table, small_batches

#: Shortest word, fewest occurrences, how much more frequent a form is, and the hash residue that drops a letter.
LENGTH, OCCURRENCES, TIMES, DROPPED = 6, 5, 5, 199
#: Code points of words in a shard, and words with one segment from which on the segment is split.
SHARD_CHARS, SEGMENT_WORDS = 400_000, 20_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
#: Rests up to this length are verified by their forms with a letter left out, longer ones by their halves again.
SHORT = 16
_RUN = re.compile("[a-zÀ-ÿ]+")


def runs(doc_id, text: str, length: int = LENGTH) -> Counter:
    """The words of a text with their numbers: lower-cased (A-Z only) runs of letters, some of which lose a letter."""
    found: Counter = Counter()
    prefix = b"" if doc_id is None else str(doc_id).encode()
    start = crc32(prefix + b":")
    for run, k in Counter(_RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
        if len(run) >= length:  # shorter ones can only become shorter
            h = crc32(run.encode(), start)
            if h % DROPPED == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < length:
                    continue
            found[run] += k
    return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """word, n of all words that are long and frequent enough; tasks count their own before the shuffle."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t:
                    total.update(runs(i, t, length))
                if len(total) >= COUNTED:
                    yield out()
        if total:
            yield out()
        release()

    return docs.select(id_col, text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


class Rests:
    """Rests of words that share a segment; ``near`` gives the values of those exactly one edit away, once each."""

    def __init__(self):
        self.full: dict = {}
        self.holes: dict = {}
        self.shorter: dict = {}
        self.halves: dict = {}

    def add(self, rest: str, value) -> None:
        n = len(rest)
        if n > SHORT:
            h = n // 2
            self.halves.setdefault((n, 0, rest[:h]), Rests()).add(rest[h:], (rest, value))
            self.halves.setdefault((n, 1, rest[h:]), Rests()).add(rest[:h], (rest, value))
            return
        self.full[rest] = value
        for i in range(n):
            self.holes.setdefault((i, rest[:i], rest[i + 1 :]), []).append((rest, value))
        for x in {rest[:i] + rest[i + 1 :] for i in range(n)}:
            self.shorter.setdefault(x, []).append(value)

    def near(self, rest: str) -> Iterator:
        n = len(rest)
        for m in (n - 1, n, n + 1):
            if m > SHORT and self.halves:
                h = m // 2
                group = self.halves.get((m, 0, rest[:h]))
                if group is not None and n >= h:
                    yield from (v for _, v in group.near(rest[h:]))
                group = self.halves.get((m, 1, rest[n - (m - h) :]))
                if group is not None and n >= m - h:
                    yield from (v for r, v in group.near(rest[: n - (m - h)]) if not rest.startswith(r[:h]))
        if n > SHORT + 1:
            return
        for i in range(n):
            for other, value in self.holes.get((i, rest[:i], rest[i + 1 :]), ()):
                if other != rest:
                    yield value
        for x in {rest[:i] + rest[i + 1 :] for i in range(n)}:
            if x in self.full:
                yield self.full[x]
        yield from self.shorter.get(rest, ())


class Shard:
    """An automaton over segments of words: half 0 is the front of its word, half 1 the end."""

    def __init__(self):
        self.automaton, self.groups, self.ready = ahocorasick.Automaton(), {}, False

    def add(self, half: int, word: str, value) -> None:
        h = len(word) // 2
        segment, rest = (word[:h], word[h:]) if half == 0 else (word[h:], word[:h])
        pair = self.groups.get(segment)
        if pair is None:
            pair = self.groups[segment] = ({}, {})
            self.automaton.add_word(segment, (len(segment), pair))
        pair[half].setdefault(len(word), Rests()).add(rest, (word, value))

    def scan(self, word: str) -> Iterator:
        """(word, value) of all held words one edit away: each segment of them counts where it has to lie."""
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        if not self.groups:
            return
        n = len(word)
        for end, (size, (fronts, ends)) in self.automaton.iter(word):
            begin = end + 1 - size
            if begin == 0 and fronts:
                for m in (n - 1, n, n + 1):
                    if m in fronts:
                        yield from fronts[m].near(word[size:])
            if end == n - 1 and ends:
                for m in (n - 1, n, n + 1):
                    if m in ends:
                        # A word whose front fits too is found by its front.
                        yield from (x for x in ends[m].near(word[:begin]) if not word.startswith(x[0][: m // 2]))


def _segments(word: Column) -> Column:
    n = F.length(word)
    h = F.expr("length(word) div 2")
    part = lambda half, x: F.struct(F.lit(half).alias("half"), x.alias("segment"))
    return F.array(part(0, F.substring(word, F.lit(1), h)), part(1, F.substring(word, h + 1, n)))


def _wanted() -> Column:
    """The segments that words near this one can have: of words one shorter, as long and one longer."""
    found = []
    for d in (-1, 0, 1):
        m = f"(length(word) + {d})"
        found.append(F.expr(f"named_struct('half', 0, 'segment', substring(word, 1, {m} div 2))"))
        found.append(F.expr(f"named_struct('half', 1, 'segment', right(word, {m} - {m} div 2))"))
    return F.array_distinct(F.array(*found))


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by shard, held segments before scanned words, words together: the sums of each scan."""
    at, shard, last = None, Shard(), None
    names = ["word", "n", "n_near", "form_n", "form"]
    for batch in batches:
        out = []
        for number, kind, half, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if number != at:
                at, shard, last = number, Shard(), None
            if kind == 0:
                shard.add(half, word, n)
            elif word != last:  # sent for several of its segments
                last = word
                found = list(shard.scan(word))
                if found:
                    best = min((-m, w) for w, m in found)
                    out.append((word, None, len(found), -best[0], best[1]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=names)
    shard = None
    release()


def near_words(words: DataFrame) -> DataFrame:
    """word, n, n_near, form_n, form of every word (word, n): how many words are one edit away, the most frequent."""
    chars = words.agg(F.sum(F.length("word"))).first()[0] or 0
    shards = max(1, math.ceil(2 * chars / SHARD_CHARS))
    held = words.select("word", "n", F.explode(_segments(F.col("word"))).alias("s")).select("word", "n", "s.half", "s.segment")
    scanned = words.select("word", F.explode(_wanted()).alias("s")).select("word", "s.half", "s.segment")
    # At most a SEGMENT_WORDS-th of twice the words.
    hot = held.groupBy("half", "segment").count().where(F.col("count") > SEGMENT_WORDS).select("half", "segment", F.ceil(F.col("count") / SEGMENT_WORDS).alias("parts"))
    hot = cut(hot)
    if hot.count():
        held = held.join(hot, ["half", "segment"], "left").withColumn("part", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))))
        scanned = scanned.join(hot, ["half", "segment"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
    else:
        held, scanned = held.withColumn("part", F.lit(0).cast("long")), scanned.withColumn("part", F.lit(0).cast("long"))
    shard = F.pmod(F.xxhash64("half", "segment", "part"), F.lit(shards)).alias("shard")
    none = F.lit(None).cast("long")
    rows = held.select(shard, F.lit(0).alias("kind"), "half", "word", "n").unionByName(scanned.select(shard, F.lit(1).alias("kind"), F.lit(0).alias("half"), "word", none.alias("n")))
    found = rows.repartition("shard").sortWithinPartitions("shard", "kind", "word").mapInArrow(_near_words, "word string, n long, n_near long, form_n long, form string")
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form"))))
    summed = own.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return summed.select("word", "n", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.form").alias("form"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root of all words with a form (word, form): forms are followed to the last by doubling. Each form is
    ``TIMES`` as frequent as its word, so no chain is longer than the logarithm of the largest number."""
    at = forms.select("word", F.col("form").alias("root"))
    longest = max(1, math.ceil(math.log(max(most, TIMES), TIMES)))
    for _ in range(math.ceil(math.log2(longest)) + 1):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = cut(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every frequent word with its near words: word, form, root, n, n_near, form_n.

    Null texts have no words; a null id counts as an empty one; repeated rows count as often as they occur. Ties for
    the form go to the smallest word in code-point order. A table without words, or an empty one, gives no rows.
    Texts and words of any length are read whole. Columns other than id and text are not read.
    """
    words = shared_table(word_counts(docs, id_col, text_col))
    near = near_words(words)
    good = F.col("form_n") >= TIMES * F.col("n")
    near = shared_table(near.select("word", "n", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")))
    most = near.agg(F.max("n")).first()[0] or 0
    last = roots(near.where("form is not null"), most)
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
