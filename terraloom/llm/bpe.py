"""Byte-pair encoding by backtracking, and decoding by an offset table (operator 6).

The longest vocabulary token from each position comes from one Aho-Corasick pass. Tokens are laid down from the
left; a token may follow another only if no merge would cross the border between them (the pair-compatibility
table, filled as pairs occur). On a dead end the last token is replaced by a shorter one. Every position is
left at most once for good, so the work is linear, and the result is exactly that of merging by rank.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import TwoGenerations, map_columns

#: Unicode White_Space, which the vocabulary's normaliser turns into one space (fixed values).
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE_RUN = regex.compile(f"[{WHITE}]+")
#: The pre-tokeniser's pattern, a part of the vocabulary file's format (fixed value).
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() also cuts at these four, which are no white space for the normaliser.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


@lru_cache(maxsize=4)
def unicode_tables(spec: str):
    """The word pattern and the lower-case map for characters on which Python's, the regex module's and the
    library's Unicode versions may differ: those that Python's tables lack. The library is asked about each."""
    tok = Tokenizer.from_str(spec)
    everything = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    doubtful = [c for c in regex.findall(r"[\p{L}\p{N}]", everything) if unicodedata.category(c) == "Cn"]
    lowered = tok.normalizer.normalize_str(" ".join(doubtful)).split(" ")
    lower = {ord(c): x for c, x in zip(doubtful, lowered, strict=True) if x != c}
    pieces = tok.pre_tokenizer.pre_tokenize_str(" ".join(f"a{c}" for c in doubtful))
    joined = {stop - 1 for _, (start, stop) in pieces if stop - start == 2}
    late = "".join(rf"\U{ord(c):08X}" for k, c in enumerate(doubtful) if 3 * k + 1 not in joined)
    words = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{late}]]+|[\p{{N}}--[{late}]]|(?:[^\s\p{{L}}\p{{N}}]|[{late}])+"
    return regex.compile(words if late else words.replace("--[]", "").replace("|[]", "")), lower


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


def split_white(text: str) -> list[str]:
    if _ODD_SPACE.search(text):
        return [x for x in _WHITE_RUN.split(text) if x]
    return text.split()


def count_words(chunk: str) -> int:
    """Words of a chunk without special tokens, in NFC and of characters that Python's tables know."""
    return len(_WORDS.findall(chunk.lower()))


class BacktrackingBpe:
    """Encoder and decoder of one vocabulary file with word ends (JSON text of the tokenizers library)."""

    def __init__(self, spec: str):
        self._pattern, self._lower = unicode_tables(spec)
        spec = json.loads(spec)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        alphabet = byte_alphabet()
        # One symbol per byte, and another for the same byte at a word's end.
        last = lambda c: chr(ord(c) + 0x400)
        self._inner = {b: alphabet[b] for b in range(256)}
        self._final = {b: last(alphabet[b]) for b in range(256)}
        spelt = {c: c for c in alphabet} | {c + end: last(c) for c in alphabet}
        self._pairs: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        rank = 0
        self._rank: dict[int, int] = {}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            whole = vocab[a + b]
            spelt[a + b] = spelt[a] + spelt[b]
            self._pairs[vocab[a], vocab[b]] = whole
            self._parts[whole] = (vocab[a], vocab[b])
            self._rank[whole] = rank
            rank += 1
        self._id = {spelt[t]: i for t, i in vocab.items() if t in spelt}
        self._spelling = {i: s for s, i in self._id.items()}
        self._automaton = ahocorasick.Automaton()
        for s, i in self._id.items():
            self._automaton.add_word(s, (len(s), i))
        self._automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._words = TwoGenerations(self._encode_word, 200_000)
        # Decoding: token texts end to end, and where each begins.
        texts = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        blobs = [texts.get(i, "").encode() for i in range(max(texts) + 1)]
        self._offset, at = [0], 0
        for b in blobs:
            self._offset.append(at := at + len(b))
        self._buffer = b"".join(blobs)

    # -- encoding
    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of a token while it is built, each with the rank of the merge that ends it."""
        found, ends = [(token, float("inf"))], float("inf")
        while token in self._parts:
            ends = self._rank[token]
            token = self._parts[token][side]
            found.append((token, ends))
        return found

    def _may_follow(self, left: int, right: int) -> bool:
        """No merge crosses the border. Of equal ranks the leftmost goes first: a merge inside ``left`` before
        one across, one across before one inside ``right``."""
        known = self._compatible.get((left, right))
        if known is None:
            known = True
            for a, a_ends in self._spine(left, 1):
                for b, b_ends in self._spine(right, 0):
                    whole = self._pairs.get((a, b))
                    if whole is not None and self._rank[whole] < a_ends and self._rank[whole] <= b_ends:
                        known = False
            if len(self._compatible) >= 2_000_000:
                self._compatible.clear()
            self._compatible[left, right] = known
        return known

    def _next_shorter(self, token: int) -> int:
        found = self._shorter.get(token)
        if found is None:
            s, found = self._spelling[token], -1
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in self._id:
                    found = self._id[s[:n]]
                    break
            self._shorter[token] = found
        return found

    def encode_symbols(self, s: str) -> list[int]:
        whole = self._id.get(s)
        if whole is not None and len(s) == 1:
            return [whole]
        n = len(s)
        longest = [-1] * (n + 1)
        for stop, (length, i) in self._automaton.iter(s):
            longest[stop + 1 - length] = i
        open_, out, lengths, at, token = bytearray(b"\1") * (n + 1), [], [], 0, longest[0]
        spelling = self._spelling
        while at < n:
            size = len(spelling[token])
            if open_[at + size] and (not out or self._may_follow(out[-1], token)):
                out.append(token)
                lengths.append(size)
                at += size
                token = longest[at]
                continue
            token = self._next_shorter(token)
            while token < 0:
                # Nothing leads on from here: take back the last token and try a shorter one in its place.
                open_[at] = 0
                token = self._next_shorter(out.pop())
                at -= lengths.pop()
        return out

    def _encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        return self.encode_symbols("".join(map(self._inner.__getitem__, raw[:-1])) + self._final[raw[-1]])

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a run without white space."""
        if "<|" in chunk and self._specials is not None:
            ids: list[int] = []
            for k, part in enumerate(self._specials.split(chunk)):
                if k % 2:
                    ids.append(self.special[part])
                elif part:
                    ids += self._encode_plain(part)
            return ids
        return self._encode_plain(chunk)

    def _encode_plain(self, chunk: str) -> list[int]:
        if chunk.isascii():
            chunk = chunk.lower()
            if chunk.isalpha():
                return self._words[chunk]
        else:
            # The library lowers character by character, so a final sigma is as any other.
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            if not chunk.isprintable():  # what Python's tables lack is not printable
                return [i for w in self._pattern.findall(chunk.translate(self._lower)) for i in self._words[w]]
        words = _WORDS.findall(chunk)
        if len(words) == 1:
            return self._words[words[0]]
        return [i for w in words for i in self._words[w]]

    def encode(self, text: str) -> list[int]:
        return [i for chunk in split_white(text) for i in self.encode_chunk(chunk)]

    # -- decoding
    def decode(self, ids: list[int]) -> str:
        """Token texts joined by spaces, as the library does where the file names no decoder."""
        b, at = self._buffer, self._offset
        return b" ".join([b[at[i] : at[i + 1]] for i in ids]).decode()


@lru_cache(maxsize=4)
def bpe_of(spec: str) -> BacktrackingBpe:
    return BacktrackingBpe(spec)


def vocabulary_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Shipped:
    """A vocabulary file's text, read once on the driver and broadcast: a few MB, whatever the data."""

    def __init__(self, spark, path: str):
        self._value = spark.sparkContext.broadcast(vocabulary_text(path))

    @property
    def text(self) -> str:
        return self._value.value

    def bpe(self) -> BacktrackingBpe:
        return bpe_of(self.text)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again: id, ids (array<int>), decoded.

    Null text counts as empty; an empty text has no ids and decodes to the empty string. Repeated rows give
    repeated results; an empty table gives an empty table; other columns are not read.
    """
    shipped = Shipped(docs.sparkSession, vocabulary)

    def make():
        bpe = shipped.bpe()
        cache = TwoGenerations(lambda c: (ids := bpe.encode_chunk(c), bpe.decode(ids)))

        def run(doc_ids, texts):
            ids, decoded = [], []
            for t in texts:
                parts = [cache[c] for c in split_white(t or "")]
                ids.append([i for p in parts for i in p[0]])
                decoded.append(" ".join([p[1] for p in parts]))
            return [doc_ids, ids, decoded]

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, ids array<int>, decoded string", make)


@lru_cache(maxsize=2)
def _spelt_chunks(spec: str) -> TwoGenerations:
    """For each chunk its number of ids, the ids spelt out, and the decoded text; kept for a worker's later tasks."""
    bpe = bpe_of(spec)

    def chunk(c):
        ids = bpe.encode_chunk(c)
        return len(ids), " ".join(map(str, ids)), bpe.decode(ids)

    return TwoGenerations(chunk)


def encode_decode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_decode``, with the number of ids and sha256 digests in place of ids and text."""
    from hashlib import sha256

    shipped = Shipped(docs.sparkSession, vocabulary)

    def make():
        get = _spelt_chunks(shipped.text).__getitem__

        def run(doc_ids, texts):
            n, ids, decoded = [], [], []
            for t in texts:
                chunks = split_white(t) if t else []
                counts, spelt, back = zip(*map(get, chunks)) if chunks else ((), (), ())
                n.append(sum(counts))
                ids.append(sha256(" ".join(spelt).encode()).hexdigest())
                decoded.append(sha256(" ".join(back).encode()).hexdigest())
            return [doc_ids, n, ids, decoded]

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(docs, [id_col, text_col], f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
