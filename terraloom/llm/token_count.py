"""Token counts with a whole-token shortcut (operator 5).

The vocabulary is a piece BPE with byte fallback. No piece holds a line break or a space mark behind another
character, so a text falls into pre-tokens (space marks, then no space) that never merge with each other. On the
driver each vocabulary string is merged on its own; those that come out as one token are proven, and a pre-token
equal to one of them counts 1 without merging. All others are merged by score.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame

from .common import TwoGenerations, map_columns

MARK = "▁"  # the vocabulary's sign for a space (fixed value)
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def merged(symbols: str, score: dict[str, float]) -> list[str]:
    """Merge neighbours whose joint string is a piece: best score first, the leftmost of equals."""
    n = len(symbols)
    if n < 2:
        return list(symbols)
    if n <= 24:
        parts = list(symbols)
        best = [score.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            top, at = None, -1
            for k, x in enumerate(best):
                if x is not None and (top is None or x > top):
                    top, at = x, k
            if top is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at:
                best[at - 1] = score.get(parts[at - 1] + parts[at])
            if at < len(best):
                best[at] = score.get(parts[at] + parts[at + 1])
    part: list[str | None] = list(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (s := score.get(part[a] + part[b])) is not None:
            heapq.heappush(heap, (-s, a, b, len(part[a]) + len(part[b])))

    for k in range(n - 1):
        offer(k, k + 1)
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if part[a] is None or part[b] is None or len(part[a]) + len(part[b]) != size:
            continue
        part[a] += part[b]
        part[b] = None
        after[a] = after[b]
        if after[a] >= 0:
            before[after[a]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [p for p in part if p is not None]


class Counter:
    """Counts the tokens of whole texts for one vocabulary: (piece, score) pairs of its ordinary pieces."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self._score = dict(pieces)
        bad = [p for p in self._score if "\n" in p or MARK in p.lstrip(MARK)]
        if bad:
            raise ValueError(f"pieces cross pre-tokens: {bad[:3]}")
        self.whole = frozenset(p for p in self._score if len(merged(p, self._score)) == 1)
        self._get = TwoGenerations(self._part).__getitem__

    def _run(self, run: str) -> int:
        if not run or run in self.whole:
            return len(run) > 0
        # What is no piece even as a single character falls back to its bytes.
        return sum(1 if p in self._score else len(p.encode()) for p in merged(run, self._score))

    def _part(self, part: str) -> int:
        """Tokens of a space mark and what follows it. A line break is one byte token and ends a run."""
        first, *rest = (MARK + part).split("\n")
        return self._run(first) + sum(1 + self._run(x) for x in rest)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum([self._get(x[1:]) for x in _RUNS.findall(MARK + text.replace(" ", MARK))])
        return sum(map(self._get, text.split(" ")))


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a model file, with scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not special(i)]


@lru_cache(maxsize=2)
def _counter(pieces: tuple) -> Counter:
    return Counter(list(pieces))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Null text counts as empty: 0 bytes, 0 tokens, not over the limit. Repeated rows give repeated results; an
    empty table gives an empty table; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(read_pieces(vocabulary)))

    def make():
        count = _counter(shipped.value).count

        def run(ids, texts):
            n = [count(t or "") for t in texts]
            return [ids, [len((t or "").encode()) for t in texts], n, [x > limit for x in n]]

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean", make)
