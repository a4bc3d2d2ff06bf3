"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

A prefix of a word has one BPE encoding, so it has one last token. An automaton over the vocabulary (a trie
with suffix links) gives, for every prefix, the tokens that are its suffixes. A token t of length k is the
last one exactly when the last token of the prefix k shorter is compatible with it, that is when merging
never crosses the border between the two; t alone must also be what BPE makes of its own text. The table
of last tokens is filled from left to right, and following it back from the end gives the ids. No merge
queue is run.

Compatibility of a pair (a, b): while a's right edge and b's left edge grow to a and b, at each moment one
piece touches the border from either side. A merge of these two pieces crosses the border if its rank comes
before either piece is taken up by its own next merge; equal ranks are taken from the left.

The vocabulary file is in the public tokenizer JSON format: NFC, white space and lower-case steps, a split
pattern, byte-level symbols, word-end suffix, added tokens. Files with other steps are refused. Its path is
a parameter and it is read once by each Python process.

Nulls count as empty texts: no tokens, empty decoded text. Texts are encoded whole, however long.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from math import inf

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from sluiceway.llm.common import Texts, map_texts

#: Chunks, and words, in a generation of what a process keeps: a bound on memory, not on words. When the
#: young generation is full it becomes the old one, and what is used again moves on to the next.
CACHE_WORDS = 300_000
CACHE_CHUNKS = 150_000
#: Pairs of tokens whose compatibility a process keeps; beyond it the table is filled anew.
CACHE_PAIRS = 500_000
#: Longer chunks are not kept.
CACHE_LENGTH = 64

#: White space of the Unicode standard; str.split() also takes \x1c-\x1f, which are none.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies, by rule: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and splitting rules of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"] or spec["decoder"] is not None or model["type"] != "BPE":
            raise ValueError(f"unsupported steps in {path}")
        self.suffix = model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in (vocab | self.added).items()}
        self._decimal = {i: str(i) for i in self.text_of}
        # Internal spelling: one character for each byte, 256 more for a byte that ends a word.
        symbols = byte_symbols()
        inner = {s: chr(b) for b, s in enumerate(symbols)}
        self.spelling = {}
        for token, number in vocab.items():
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            spelt = "".join(inner[c] for c in body)
            self.spelling[number] = spelt[:-1] + chr(ord(spelt[-1]) + 256) if ends else spelt
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_from: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            made = vocab[left + right]
            pair = (vocab[left], vocab[right])
            self.merges[pair] = (rank, made)
            self.made_from.setdefault(made, (rank, *pair))
        self._edges: tuple[dict[int, list[tuple[int, float]]], ...] = ({}, {})
        self._ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        # A token is usable if BPE makes it of its own text: its two parts are, and they don't block each other.
        self.usable: set[int] = set()
        singles = {n for n, s in self.spelling.items() if len(s) == 1}
        self.usable |= singles
        for made, (rank, left, right) in sorted(self.made_from.items(), key=lambda x: x[1][0]):
            if left in self.usable and right in self.usable and self._border_holds(left, right, rank):
                self.usable.add(made)
        self.automaton = ahocorasick.Automaton()
        for number in self.usable:
            self.automaton.add_word(self.spelling[number], (len(self.spelling[number]), number))
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._shift = max(self.spelling) + 1
        self._sizes = {number: len(spelt) for number, spelt in self.spelling.items()}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces that touch a token's left (0) or right (1) border, smallest first, each with the rank of
        the merge that takes it up (infinite for the token itself)."""
        known = self._edges[side].get(token)
        if known is None:
            known, piece, until = [], token, inf
            while True:
                known.append((piece, until))
                if piece not in self.made_from:
                    break
                until, *parts = self.made_from[piece]
                piece = parts[side]
            known.reverse()
            self._edges[side][token] = known
        return known

    def _border_holds(self, a: int, b: int, before: float = inf) -> bool:
        """Whether no merge of rank under `before` crosses the border between a and b."""
        left, right, ranks = self._edge(a, 1), self._edge(b, 0), self._ranks
        i = j = 0
        x, x_until = left[0]
        y, y_until = right[0]
        while True:
            rank = ranks.get((x, y))
            if rank is not None and rank < before and rank < x_until and rank <= y_until:
                return False
            if x_until <= y_until:
                if x_until >= before:  # also when both are infinite: nothing is left to merge
                    return True
                i += 1
                x, x_until = left[i]
            else:
                if y_until >= before:
                    return True
                j += 1
                y, y_until = right[j]

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b apart when their texts stand side by side."""
        pair = a * self._shift + b
        known = self._pairs.get(pair)
        if known is None:
            known = self._border_holds(a, b)
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            self._pairs[pair] = known
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one piece of the split pattern."""
        data = word.encode("utf-8", "surrogatepass")
        spelt = data.decode("latin-1")
        if self.suffix:
            spelt = spelt[:-1] + chr(data[-1] + 256)
        last = [-1] * len(spelt)  # the last token of the prefix that ends here
        pairs, compatible, shift = self._pairs, self.compatible, self._shift
        for end, (size, token) in self.automaton.iter(spelt):  # longest first at each end
            if last[end] >= 0:
                continue
            if size > end:
                last[end] = token
                continue
            before = last[end - size]
            if before >= 0:
                fits = pairs.get(before * shift + token)
                if fits is None:
                    fits = compatible(before, token)
                if fits:
                    last[end] = token
        ids, at, sizes = [], len(spelt) - 1, self._sizes
        while at >= 0:
            ids.append(last[at])
            at -= sizes[last[at]]
        return ids[::-1]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a normalised piece of text without white space."""
        return [i for word in self.pattern.findall(chunk) for i in self.encode_word(word)]

    def decode(self, ids: Iterable[int]) -> str:
        """Texts of the ids joined by one space, special tokens too, as a vocabulary without a decoder step has it."""
        texts = self.text_of
        try:
            return " ".join([texts[i] for i in ids])
        except KeyError:  # ids outside the vocabulary decode to nothing
            return " ".join([texts[i] for i in ids if i in texts])

    def as_text(self, ids: Iterable[int]) -> str:
        """Decimal ids joined by one space."""
        numbers = self._decimal
        return " ".join([numbers[i] for i in ids])


def normalise(text: str) -> str:
    """NFC and lower case character by character; a capital sigma has one lower form wherever it stands."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def chunks(text: str) -> list[str]:
    return _SPACE.split(text) if _SEPARATORS.search(text) else text.split()


class Recent(dict):
    """What was made for recent keys, in two generations."""

    def __init__(self, make: Callable, room: int):
        super().__init__()
        self._make, self._room, self._old = make, room, {}

    def __missing__(self, key: str):
        found = self._old.get(key)
        if found is None:
            found = self._make(key)
        if len(key) <= CACHE_LENGTH:
            if len(self) >= self._room:
                self._old = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    """Encodes texts, keeping the ids of recent words and chunks as packed 32-bit numbers."""

    def __init__(self, path: str, words: int = CACHE_WORDS, cached_chunks: int = CACHE_CHUNKS):
        self.vocabulary = load(path)
        self._words, self._chunks = Recent(self._word, words), Recent(self._chunk, cached_chunks)

    def _word(self, word: str) -> bytes:
        return array("i", self.vocabulary.encode_word(word)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._words[chunk]
        if chunk[:-1].isalpha():  # a word and one other character; only an apostrophe could bind them, and it would come first
            return self._words[chunk[:-1]] + self._words[chunk[-1]]
        return b"".join([self._words[w] for w in self.vocabulary.pattern.findall(chunk)])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        if not text:
            return []
        pieces = self.vocabulary.added_pattern.split(text) if self.vocabulary.added_pattern else [text]
        parts: list[bytes] = []
        for k, piece in enumerate(pieces):
            if k % 2:
                parts.append(array("i", [self.vocabulary.added[piece]]).tobytes())
            else:
                parts += [self._chunks[c] for c in chunks(normalise(piece)) if c]
        return np.frombuffer(b"".join(parts), dtype=np.int32).tolist()

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids as text, the text they decode to."""
        ids = self.encode(text)
        return len(ids), self.vocabulary.as_text(ids), self.vocabulary.decode(ids)


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids: decimal ids joined by one space."""

    def make() -> Callable[[Texts], dict[str, list]]:
        codec = Codec(path)

        def work(texts: Texts) -> dict[str, list]:
            found = [codec.digest(t)[:2] for t in texts]
            return {"n_tokens": [x[0] for x in found], "ids": [x[1] for x in found]}

        return work

    return map_texts(df, key, text, make, "n_tokens long, ids string")


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, decoded: the texts of space-joined decimal ids, joined by one space; null or empty ids give an empty text."""

    def make() -> Callable[[Texts], dict[str, list]]:
        vocabulary = load(path)
        return lambda rows: {"decoded": [vocabulary.decode(map(int, (x or "").split())) for x in rows]}

    return map_texts(df, key, ids, make, "decoded string")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass."""

    def make() -> Callable[[Texts], dict[str, list]]:
        codec = Codec(path)

        def work(texts: Texts) -> dict[str, list]:
            found = [codec.digest(t) for t in texts]
            return {"n_tokens": [x[0] for x in found], "ids_sha256": [_sha(x[1]) for x in found], "decoded_sha256": [_sha(x[2]) for x in found]}

        return work

    return map_texts(df, key, text, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_checked(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids (decimal, joined by one space), decoded_sha256 of the text they decode to."""

    def make() -> Callable[[Texts], dict[str, list]]:
        codec = Codec(path)

        def work(texts: Texts) -> dict[str, list]:
            found = [codec.digest(t) for t in texts]
            return {"n_tokens": [x[0] for x in found], "ids": [x[1] for x in found], "decoded_sha256": [_sha(x[2]) for x in found]}

        return work

    return map_texts(df, key, text, make, "n_tokens long, ids string, decoded_sha256 string")
