"""Language identification by segmentation-marginalised unigrams (operator 7).

Pieces are all letter strings of a fixed public vocabulary. Each language has a probability for every piece, fitted by
expectation maximisation. A word's probability in a language is the sum over all its segmentations into pieces, found
by the forward algorithm in logarithms, however long the word; a text's is the product over its words. The posterior
over languages decides.

The fit is on a bounded sample of texts of each language. Their words' counts stay a table; in each round its
partitions find the expected counts of the pieces, and the driver adds up one vector for each partition.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, cut, map_columns, release, small_batches

#: Training texts for each language, chosen by a hash of the id; the bound of the fit. Rounds of it, the count that
#: every piece has from the start, and the parts in which the bounded sample is worked on.
TEXTS_PER_LANGUAGE, ROUNDS, SMOOTH, PARTS = 300, 3, 0.02, 8
#: Letters whose sums are worked out at once.
LETTERS = 1 << 17
#: The share of training texts that may be as unlikely a letter as the least likely text of a known language, and the
#: room (natural logarithm, per letter) that texts get below these.
ODDEST, ROOM = 0.01, 0.3
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: The pattern also takes numbers that are no decimal digits; words with these are rare and cut at them.
_NUMBERS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def letters_of(word: str) -> list[str]:
    """The runs of letters of a word."""
    return [word] if word.isalpha() else _LETTERS.findall(word)


def read_vocabulary(path: str) -> list[str]:
    """Distinct lower-case letter strings among the pieces of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if p.isalpha())


def _chunks(runs: list[str], order: list[int]):
    """Parts of the order, of alike lengths, whose table of positions stays small."""
    part: list[int] = []
    for k in order:  # ascending lengths
        if part and (len(part) + 1) * (len(runs[k]) + 1) > LETTERS:
            yield part
            part = []
        part.append(k)
    if part:
        yield part


class Model:
    """langs, and log probabilities of the pieces [piece, language]; the last row is for a letter that is no piece.
    ``least`` has for each language the log probability per letter below which a text is not taken for it."""

    def __init__(self, langs: list[str], vocabulary: list[str], log_p: np.ndarray, least: np.ndarray | None = None):
        self.langs, self.vocabulary, self.log_p = langs, vocabulary, log_p
        self.least = np.full(len(langs), -np.inf) if least is None else least

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("langs", "vocabulary", "log_p", "least")}

    @cached_property
    def single(self) -> dict[str, int]:
        return {p: k for k, p in enumerate(self.vocabulary) if len(p) == 1}

    @cached_property
    def automaton(self):
        found = ahocorasick.Automaton()
        for k, p in enumerate(self.vocabulary):
            if len(p) > 1:
                found.add_word(p, len(p) << 32 | k)
        if len(found):
            found.make_automaton()
        return found

    def arcs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Run, start, stop and piece of every piece in every run, in the order of their stops and then runs."""
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        begin = np.cumsum(size + 1) - size - 1
        line = "\n".join(runs)
        get, unknown = self.single.get, len(self.vocabulary)
        singles = np.fromiter((get(c, unknown) for c in line), np.int64, len(line))
        at = np.flatnonzero(np.fromiter((c != "\n" for c in line), bool, len(line)))
        longer = np.array(list(self.automaton.iter(line)) if len(self.automaton) else [], np.int64).reshape(-1, 2)
        end = np.concatenate([at, longer[:, 0]])
        length = np.concatenate([np.ones(len(at), np.int64), longer[:, 1] >> 32])
        piece = np.concatenate([singles[at], longer[:, 1] & 0xFFFFFFFF])
        run = np.searchsorted(begin, end, side="right") - 1
        stop = end - begin[run] + 1
        order = np.argsort(stop * len(runs) + run, kind="stable")
        run, stop, piece = run[order], stop[order], piece[order]
        return run, stop - length[order], stop, piece

    def forward(self, runs: list[str], arcs=None) -> np.ndarray:
        """alpha[run, position, language]: the log of the summed probability of all segmentations up to a position."""
        run, start, stop, piece = self.arcs(runs) if arcs is None else arcs
        size = max(map(len, runs))
        alpha = np.zeros((len(runs), size + 1, len(self.langs)))
        edges = np.searchsorted(stop, np.arange(1, size + 2))
        firsts = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (stop[1:] != stop[:-1])])
        cuts = np.searchsorted(firsts, edges)
        for t in range(1, size + 1):
            part = slice(edges[t - 1], edges[t])
            first = firsts[cuts[t - 1] : cuts[t]]
            terms = alpha[run[part], start[part]] + self.log_p[piece[part]]
            alpha[run[first], t] = np.logaddexp.reduceat(terms, first - edges[t - 1], axis=0)
        return alpha

    def log_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, [word, language]."""
        parts = [(i, s) for i, w in enumerate(words) for s in letters_of(w)]
        out = np.zeros((len(words), len(self.langs)))
        runs = [s for _, s in parts]
        for chunk in _chunks(runs, sorted(range(len(runs)), key=lambda k: len(runs[k]))):
            own = [runs[k] for k in chunk]
            alpha = self.forward(own)
            np.add.at(out, [parts[k][0] for k in chunk], alpha[np.arange(len(own)), [len(r) for r in own]])
        return out

    def expected(self, runs: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces, [piece, language], over all segmentations (forward-backward); ``weight`` is
        each run's count in each language."""
        into = np.zeros_like(self.log_p)
        for chunk in _chunks(runs, sorted(range(len(runs)), key=lambda k: len(runs[k]))):
            own, w = [runs[k] for k in chunk], weight[chunk]
            run, start, stop, piece = arcs = self.arcs(own)
            alpha = self.forward(own, arcs)
            length = np.array([len(r) for r in own])
            beta = np.full_like(alpha, -np.inf)
            beta[np.arange(len(own)), length] = 0
            back = np.argsort(-start * len(own) + run, kind="stable")
            r, a, b, p = run[back], start[back], stop[back], piece[back]
            firsts = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (a[1:] != a[:-1])])
            edges = np.r_[np.flatnonzero(np.r_[True, a[1:] != a[:-1]]), len(a)]
            cuts = np.searchsorted(firsts, edges)
            for k in range(len(edges) - 1):
                part = slice(edges[k], edges[k + 1])
                first = firsts[cuts[k] : cuts[k + 1]]
                beta[r[first], a[first]] = np.logaddexp.reduceat(self.log_p[p[part]] + beta[r[part], b[part]], first - edges[k], axis=0)
            share = np.exp(alpha[run, start] + self.log_p[piece] + beta[run, stop] - beta[run, 0]) * w[run]
            for j in range(len(self.langs)):
                into[:, j] += np.bincount(piece, share[:, j], minlength=len(into))
        return into


def start(langs: list[str], vocabulary: list[str]) -> Model:
    return Model(langs, vocabulary, np.full((len(vocabulary) + 1, len(langs)), -np.log(len(vocabulary) + 1)))


def improved(model: Model, expected: np.ndarray, smooth: float = SMOOTH) -> Model:
    """The next round's model from the expected counts of all pieces."""
    total = expected + smooth
    return Model(model.langs, model.vocabulary, np.log(total / total.sum(axis=0)))


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """lang, text of at most ``per_language`` rows of each language, those with the smallest hash of their id."""
    # One row for each language is broadcast. A hash below a bound that twice the wanted rows of the language pass,
    # then the smallest hashes of those.
    hashed = rows.select("id", "lang", F.xxhash64("id", "text").alias("h"))
    share = F.least(F.lit(1.0), 2.0 * (per_language + 50) / F.count("*"))
    few = hashed.join(F.broadcast(hashed.groupBy("lang").agg(share.alias("share"))), "lang").where(F.col("h") / 2.0**64 + 0.5 <= F.col("share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = cut(few.withColumn("r", rank).where(F.col("r") <= per_language).select("lang", "h").distinct())
    wanted = F.broadcast(chosen) if chosen.count() <= 1_000_000 else chosen
    return rows.withColumn("h", F.xxhash64("id", "text")).join(wanted, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("lang", "text", "h")


def train(docs: DataFrame, vocabulary: str, per_language: int = TEXTS_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most ``per_language`` whole texts of each language among the given rows: a bounded sample, in which
    the rows of a text repeated under one id count once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    sample = cut(_sample(rows, per_language).repartition(PARTS, "h"))
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    model = start(langs, read_vocabulary(vocabulary))
    if not langs:
        return model

    def make():
        def run(langs, texts):
            tally: dict[str, Counter] = {}
            for lang, text in zip(langs, texts):
                tally.setdefault(lang, Counter()).update(s for w in words_of(text) for s in letters_of(w))
            flat = [(g, w, n) for g, c in tally.items() for w, n in c.items()]
            return [list(x) for x in zip(*flat)] if flat else [[], [], []]

        return run

    counts = map_columns(sample, ["lang", "text"], "lang string, word string, n long", make)
    per_word = [F.coalesce(F.sum(F.when(F.col("lang") == g, F.col("n"))), F.lit(0)).cast("double") for g in langs]
    counts = cut(counts.groupBy("word").agg(F.array(*per_word).alias("n")).repartition(PARTS, "word"))
    small_batches(docs.sparkSession, 8192)
    for _ in range(ROUNDS):
        model = improved(model, _expected(counts, model))
    return Model(model.langs, model.vocabulary, model.log_p, _least(sample, model))


def _sums(counts: DataFrame, model: Model) -> DataFrame:
    """Vectors whose sum is the expected counts of all words: at most ``PARTS``, also where the session deals the words
    to more partitions."""
    shipped = counts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own, total = shipped.value, None
        for batch in batches:
            if batch.num_rows:
                found = own.expected(batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist()))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])
        release()

    return counts.coalesce(PARTS).mapInArrow(run, "sum binary")


def _expected(counts: DataFrame, model: Model) -> np.ndarray:
    sums = _sums(counts, model).collect()
    return sum((np.frombuffer(bytes(r["sum"])).reshape(model.log_p.shape) for r in sums), np.zeros_like(model.log_p))


def _least(sample: DataFrame, model: Model) -> np.ndarray:
    """For each language, what all but the oddest of its training texts reach per letter, less some room."""
    shipped = sample.sparkSession.sparkContext.broadcast(model)

    def make():
        of = predictor(shipped.value)
        return lambda langs, texts: [langs, of(texts, of_langs=langs)[2]]

    rates = map_columns(sample, ["lang", "text"], "lang string, rate double", make).where("rate is not null")
    low = {r["lang"]: r["low"] for r in rates.groupBy("lang").agg(F.percentile_approx("rate", ODDEST).alias("low")).collect()}
    return np.array([low[g] - ROOM if g in low else -np.inf for g in model.langs])


def predictor(model: Model):
    """A function from texts to (languages, scores, log probabilities per letter in that language, or in ``of_langs``
    if these are given), for use within tasks. It remembers the words it has scored."""
    langs = model.langs
    column = {g: j for j, g in enumerate(langs)}
    row_of: dict[str, int] = {}
    matrix = np.zeros((0, len(langs) + 1))  # the last column: letters

    def run(texts: list, of_langs: list | None = None) -> tuple[list[str], list[float], list[float | None]]:
        nonlocal matrix
        if len(row_of) > 400_000:
            row_of.clear()
        lists = [words_of(t) if t and langs else [] for t in texts]
        new = list({w for ws in lists for w in ws if w not in row_of})
        if new:
            used = len(row_of)
            row_of.update(zip(new, range(used, used + len(new))))
            letters = [len(w) if w.isalpha() else sum(map(len, letters_of(w))) for w in new]
            matrix = _grown(matrix, used, np.column_stack([model.log_words(new), letters]))
        pred, score, rate = [], [], []
        for k, ws in enumerate(lists):
            total = matrix[np.fromiter(map(row_of.__getitem__, ws), np.int64, len(ws))].sum(axis=0) if ws else np.zeros(1)
            letters = total[-1]
            if not letters:
                pred.append(UNKNOWN)
                score.append(0.0)
                rate.append(None)
                continue
            total = total[:-1]
            best = int(total.argmax())
            pred.append(langs[best])
            score.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
            rate.append(float(total[best if of_langs is None else column[of_langs[k]]] / letters))
        return pred, score, rate

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: id, lang_pred, score (the posterior of lang_pred; 0 for ``und``).

    A text that is null or has no letter is ``und``; so is every text if no language was learned. Equal posteriors
    go to the first language by name. Repeated rows and other columns change nothing; an empty table gives an empty
    table. Very long texts and very long words are scored whole.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = predictor(shipped.value)
        return lambda ids, texts: [ids, *of(texts)[:2]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, lang_pred string, score double", make)


def _grown(matrix: np.ndarray, used: int, rows: np.ndarray) -> np.ndarray:
    """matrix with rows written at ``used``; its room doubles when it is full."""
    need = used + len(rows)
    if need > len(matrix):
        matrix = np.concatenate([matrix[:used], np.zeros((max(need, 2 * used) - used, rows.shape[1]))])
    matrix[used:need] = rows
    return matrix


def identify(docs: DataFrame, vocabulary: str, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """Train on the documents outside the held-out fold and predict all: doc_id, held_out, lang_pred, score."""
    fold = crc_mod("doc_id", folds)
    model = train(docs.where(fold != held_out_fold), vocabulary)
    return predict(docs, model).withColumn("held_out", F.coalesce(fold == held_out_fold, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")
