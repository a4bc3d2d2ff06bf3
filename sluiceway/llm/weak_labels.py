"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Documents with the same votes are
one pattern, so the corpus shrinks to a table of at most 3 ** labellers counts, and expectation-maximisation
on it estimates each labeller's vote probabilities for good and for bad documents (hence its accuracy) and the
share of good ones. No gold label is used. The posterior of a document's pattern is its label for a linear
scorer on hashed features (words, word shapes, buckets of the measures), trained by logistic regression on at
most `SAMPLE_DOCS` documents, those with the smallest hashed ids, and applied to all.

Null and empty texts have no words: the labellers see that like any other property. Without any document
there is nothing to learn, and an empty table gives an empty result. Repeated rows count and are scored one by one.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Texts, map_arrow, map_texts, slices
from sluiceway.llm.rules_cascade import SYMBOLS, Measures

#: Documents that train the scorer, hashed features, steps of its training.
SAMPLE_DOCS = 4000
FEATURES = 1 << 18
STEPS = 150
RATE = 0.3
DECAY = 1e-6
#: Rounds of expectation-maximisation, and the share of good documents it starts from.
ROUNDS = 60
START_GOOD = 0.8
#: Score from which a document is kept.
KEEP = 0.5
#: Words whose features a process keeps; beyond it the table is filled anew.
CACHE_WORDS = 200_000

GOOD, BAD, NONE = 2, 1, 0

Vote = Callable[[Measures], int]


def _bad_if(fires: bool) -> int:
    return BAD if fires else NONE


_SIGNS = bytes.maketrans(SYMBOLS + b"?\n\t", b"#" * len(SYMBOLS) + b".  ")


def _folded(m: Measures) -> bytes:
    return m.data.translate(_SIGNS) + b" "


def _ending(m: Measures, sign: bytes) -> float:
    """Share of words that end in a sign: `.` stands for a question mark too, `#` for any of the symbols."""
    return _folded(m).count(sign + b" ") / max(m.n_words, 1)


def _letters(m: Measures) -> float:
    upper, lower = m.upper_lower
    return upper / max(upper + lower, 1)


def _doubled(m: Measures) -> float:
    return sum(map(eq, m.words, m.words[1:])) / max(m.n_words - 1, 1)


def _variety(m: Measures) -> int:
    return _bad_if(m.n_words >= 30 and len(set(m.words)) < 0.3 * m.n_words and m.n_words < 2000)


def _sentences(m: Measures) -> int:
    share = _ending(m, b".")
    return NONE if m.n_words < 20 else GOOD if 0.02 < share < 0.4 else BAD


def _clean_ends(m: Measures) -> int:
    share = _ending(m, b"#") + _ending(m, b"!!")
    return GOOD if m.n_words >= 10 and share < 0.02 else BAD if share > 0.15 else NONE


#: The labellers, by name. Most know one kind of junk and stay silent otherwise; every kind is known to several.
LABELLERS: dict[str, Vote] = {
    "length": lambda m: _bad_if(m.n_words < 10),
    "repeats": lambda m: _bad_if(5 * m.n_repeat_words > m.n_words),
    "doubled_words": lambda m: _bad_if(_doubled(m) > 0.2),
    "lines": lambda m: _bad_if(m.n_lines >= 8 and 2 * m.n_dup_lines > m.n_lines),
    "variety": _variety,
    "symbols": lambda m: _bad_if(5 * m.n_symbols > m.n_words),
    "symbol_chars": lambda m: _bad_if(20 * m.n_symbols > m.word_chars),
    "clean_ends": _clean_ends,
    "upper_case": lambda m: _bad_if(_letters(m) > 0.4 and m.n_words >= 10),
    "shouting": lambda m: _bad_if(_ending(m, b"!!") > 0.1),
    "word_length": lambda m: _bad_if(not m.n_words or m.word_chars > 15 * m.n_words),
    "sentences": _sentences,
}


def votes_of(m: Measures) -> int:
    """All votes as one number in base 3."""
    pattern = 0
    for vote in LABELLERS.values():
        pattern = pattern * 3 + vote(m)
    return pattern


def _digits(patterns: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers % 3


class LabelModel:
    """Vote probabilities by class, share of good documents, posterior of each pattern that occurs."""

    def __init__(self, counts: dict[int, int], rounds: int = ROUNDS):
        patterns = np.array(sorted(counts), dtype=np.int64)
        weight = np.array([counts[p] for p in sorted(counts)], dtype=float)
        votes = _digits(patterns) if len(patterns) else np.zeros((0, len(LABELLERS)), dtype=np.int64)
        lead = 2 + (votes == GOOD).sum(axis=1) - 4 * (votes == BAD).sum(axis=1)  # start: any warning outweighs silence
        good = 1 / (1 + np.exp(-lead.astype(float)))
        self.share = START_GOOD
        self.table = np.full((2, len(LABELLERS), 3), 1 / 3)  # class (bad, good), labeller, vote
        for _ in range(rounds if len(patterns) else 0):
            for kind, part in enumerate((1 - good, good)):
                for v in range(3):
                    self.table[kind, :, v] = ((votes == v) * (weight * part)[:, None]).sum(axis=0) + 0.1
            self.table /= self.table.sum(axis=2, keepdims=True)
            self.share = float(np.clip((weight * good).sum() / weight.sum(), 0.01, 0.99))
            good = self._good(votes)
        self.known = dict(zip(patterns.tolist(), good.tolist(), strict=True))

    def _good(self, votes: np.ndarray) -> np.ndarray:
        each = np.log(self.table)[:, np.arange(len(LABELLERS)), votes].sum(axis=2)
        odds = each[1] - each[0] + math.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def posterior(self, pattern: int) -> float:
        """Probability that a document with these votes is good."""
        found = self.known.get(pattern)
        return float(self._good(_digits(np.array([pattern])))[0]) if found is None else found

    def accuracies(self) -> dict[str, float]:
        """Probability that a vote of each labeller is right."""
        right = self.share * self.table[1, :, GOOD] + (1 - self.share) * self.table[0, :, BAD]
        cast = right + self.share * self.table[1, :, BAD] + (1 - self.share) * self.table[0, :, GOOD]
        return dict(zip(LABELLERS, (right / cast).tolist(), strict=True))


_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))


_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def _slot(name: bytes) -> int:
    return zlib.crc32(name) % FEATURES


class Features:
    """Hashed features of a document: for each word itself and its shape, and buckets of the measures."""

    def word(self, word: bytes) -> tuple[int, int]:
        """Slots of a word and of its shape."""
        return _slot(b"w" + word.lower()), _slot(b"s" + _RUN.sub(rb"\1", word[:64].translate(_SHAPE)))

    def buckets(self, m: Measures) -> list[int]:
        """Slots of the bucketed measures."""
        shares = {
            b"rep": m.n_repeat_words / max(m.n_words, 1), b"sym": m.n_symbols / max(m.n_words, 1), b"upp": _letters(m),
            b"dou": _doubled(m), b"dup": m.n_dup_lines / max(m.n_lines, 1), b"len": math.log2(m.n_words + 1) / 16,
        }
        return [_slot(b"b%s%d" % (name, min(int(10 * share), 20))) for name, share in shares.items()]

    def __call__(self, m: Measures) -> dict[int, float]:
        """Slot -> value: words weigh 4 together, each bucket 1."""
        found: dict[int, float] = Counter()
        for word, n in Counter(m.words).items():
            for slot in self.word(word):
                found[slot] += 4 * n / m.n_words
        for slot in self.buckets(m):
            found[slot] += 1.0
        return found


class Scorer(dict):
    """A trained scorer: what each recent word adds, and the score of a document."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.features = weights, Features()

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = float(sum(self.weights[s] for s in self.features.word(word)))
        return found

    def score(self, m: Measures) -> float:
        """Probability of good quality: words weigh 4 together, each bucket 1, as in training."""
        total = float(self.weights[FEATURES]) + float(sum(self.weights[s] for s in self.features.buckets(m)))
        if m.n_words:
            total += 4 * sum(map(self.__getitem__, m.words)) / m.n_words
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def train_scorer(rows: list[dict[int, float]], labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression towards probabilities, the last one the constant; steps scaled by past gradients."""
    weights, squares = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    if not rows:
        return weights
    doc = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    slot = np.array([s for r in rows for s in (*r, FEATURES)])
    value = np.array([v for r in rows for v in (*r.values(), 1.0)])
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.bincount(doc, weights=weights[slot] * value, minlength=len(rows))))
        gradient = np.bincount(slot, weights=((chance - labels) / len(rows))[doc] * value, minlength=FEATURES + 1) + DECAY * weights
        squares += gradient * gradient
        weights -= RATE * gradient / np.sqrt(squares)
    return weights


def vote_counts(df: DataFrame, text: str) -> dict[int, int]:
    """How many documents have each pattern of votes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for _, texts in slices(batch, 0):
                counts.update(votes_of(Measures(t)) for t in texts)
        yield pa.RecordBatch.from_pydict({"pattern": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64())})

    picked = df.select(F.col(f"`{text}`").cast("string").alias("_text"))
    rows = map_arrow(picked, run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()  # at most 3 ** labellers
    return {r["pattern"]: r["n"] for r in rows}


def sample_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """One text for each of at most SAMPLE_DOCS ids, the smallest where an id has several; a repeated id counts once."""
    ids = df.select(F.col(f"`{key}`").alias("_key")).where("_key is not null").distinct()
    sample = ids.orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_DOCS)
    texts = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text")).join(F.broadcast(sample), "_key")
    return texts.groupBy("_key").agg(F.min("_text").alias("_text")).select("_text")


def learn(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[LabelModel, np.ndarray]:
    """The label model from all rows, and the scorer's weights from the sample."""
    model = LabelModel(vote_counts(df, text))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for _, values in slices(batch, 0):
                measures = [Measures(v) for v in values]
                rows = [features(m) for m in measures]
                yield pa.RecordBatch.from_pydict({
                    "pattern": pa.array([votes_of(m) for m in measures], pa.int64()), "slots": pa.array([list(r) for r in rows], pa.list_(pa.int32())),
                    "values": pa.array([list(r.values()) for r in rows], pa.list_(pa.float32())),
                })

    got = map_arrow(sample_texts(df, key, text), run, "pattern long, slots array<int>, values array<float>").toArrow()
    patterns, slots, values = (got.column(c).to_pylist() for c in ("pattern", "slots", "values"))
    rows = [dict(zip(s, v, strict=True)) for s, v in zip(slots, values, strict=True)]
    order = sorted(range(len(rows)), key=lambda k: (patterns[k], slots[k]))  # sums in a fixed order
    return model, train_scorer([rows[k] for k in order], np.array([model.posterior(patterns[k]) for k in order]))


def classify(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, label_posterior, score (probability of good quality), kept for every row."""
    model, weights = learn(df, key, text)
    shared = df.sparkSession.sparkContext.broadcast((model, weights.astype(np.float32)))

    def make() -> Callable[[Texts], dict[str, list]]:
        model, weights = shared.value
        scorer = Scorer(weights)

        def work(texts: Texts) -> dict[str, list]:
            measures = [Measures(t) for t in texts]
            scores = [scorer.score(m) for m in measures]
            return {"label_posterior": [model.posterior(votes_of(m)) for m in measures], "score": scores, "kept": [x >= KEEP for x in scores]}

        return work

    return map_texts(df, key, text, make, "label_posterior double, score double, kept boolean")
