"""Language identification by a byte convolutional network, trained and applied in numpy.

The network embeds bytes, runs filters of several widths over a window of fixed length, takes each filter's
maximum over the window and classifies the maxima by a softmax layer. It is trained on windows of a bounded
sample of labelled documents: at most `PER_LANGUAGE` documents a language, those with the smallest hashed
ids, and at most `TRAIN_WINDOWS` windows of each. It is then applied to every window of every text: texts
are cut into adjacent windows whatever their length, windows go through the network in batches, and the
language with the largest mean log-probability wins. `score` is its probability under these means.

For inference the first layers are folded into tables: a filter's response is a sum of table rows for pairs of
bytes, so no multiplication is left for each byte.

Null texts and texts without a letter are `und` with score 0. Without any labelled row every text is `und`.
Rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import Texts, map_arrow, map_texts, slices

#: Bounds of the training sample: documents of a language, and languages (the most frequent ones).
PER_LANGUAGE = 600
MOST_LANGUAGES = 1000
TRAIN_WINDOWS = 8

#: The network.
WINDOW_BYTES = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8

#: Training.
EPOCHS = 6
BATCH = 128
RATE = 0.004
SEED = 7

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")

#: Windows that pass through the tables at once.
_TOGETHER = 64


def windows_of(text: str) -> np.ndarray:
    """A text's bytes in lower case, as rows of adjacent windows; the last is filled up with spaces."""
    data = text.lower().encode("utf-8", "surrogatepass")
    n = max(1, -(-len(data) // WINDOW_BYTES))
    room = np.full(n * WINDOW_BYTES, 0x20, dtype=np.uint8)
    room[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return room.reshape(n, WINDOW_BYTES)


class ByteNetwork:
    """Weights of the network: embedding, a weight matrix and bias for each filter width, output layer."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.output = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.shift]

    def step(self, rows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss on a batch and the gradient of every parameter."""
        n = len(rows)
        embedded = self.embedding[rows]
        pooled, picked = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            span = WINDOW_BYTES - width + 1
            patches = np.concatenate([embedded[:, k : k + span] for k in range(width)], axis=2)
            responses = patches @ weights + bias
            at = responses.argmax(axis=1)
            picked.append((patches, at))
            pooled.append(np.take_along_axis(responses, at[:, None, :], axis=1)[:, 0])
        raw = np.concatenate(pooled, axis=1)
        hidden = np.maximum(raw, 0)
        scores = hidden @ self.output + self.shift
        scores -= scores.max(axis=1, keepdims=True)
        chances = np.exp(scores)
        chances /= chances.sum(axis=1, keepdims=True)
        loss = float(-np.log(chances[np.arange(n), labels] + 1e-9).mean())
        error = chances.copy()
        error[np.arange(n), labels] -= 1
        error /= n
        back = (error @ self.output.T) * (raw > 0)
        embedding_gradient = np.zeros_like(self.embedding)
        filter_gradients, bias_gradients = [], []
        for k, (width, weights) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            patches, at = picked[k]
            best = np.take_along_axis(patches, at[:, :, None], axis=1)  # batch, filter, width * embedding
            filter_gradients.append(np.einsum("bf,bfe->ef", own, best))
            bias_gradients.append(own.sum(axis=0))
            to_bytes = own[:, :, None] * weights.T[None]
            for j in range(width):
                np.add.at(embedding_gradient, np.take_along_axis(rows, at + j, axis=1), to_bytes[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
        return loss, [embedding_gradient, *filter_gradients, *bias_gradients, hidden.T @ error, error.sum(axis=0)]

    def train(self, rows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam over shuffled batches in which languages weigh equally."""
        rng = np.random.default_rng(seed)
        counts = np.bincount(labels, minlength=len(self.languages))
        chance = 1.0 / counts[labels]
        chance /= chance.sum()
        means = [np.zeros_like(p) for p in self.parameters()]
        squares = [np.zeros_like(p) for p in self.parameters()]
        steps = max(40, epochs * len(rows) // BATCH)
        for t in range(1, steps + 1):
            picked = rng.choice(len(rows), size=min(BATCH, len(rows)), p=chance)
            _, gradients = self.step(rows[picked], labels[picked])
            rate = RATE * (1 - (t - 1) / steps)
            for p, g, m, v in zip(self.parameters(), gradients, means, squares, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)

    def fold(self) -> Tables:
        return Tables(self)


class Tables:
    """The trained network as sums of table rows."""

    def __init__(self, network: ByteNetwork):
        self.languages, self.output, self.shift = network.languages, network.output, network.shift
        self.bias = np.concatenate(network.biases)
        single = [[network.embedding @ weights[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(width)] for width, weights in zip(WIDTHS, network.filters, strict=True)]

        def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return (first[:, None, :] + second[None, :, :]).reshape(65536, FILTERS)

        (a0, a1), (b0, b1, b2), (c0, c1, c2, c3) = single
        self.first = np.concatenate([pair(a0, a1), pair(b0, b1), pair(c0, c1)], axis=1)
        self.third = b2
        self.last = pair(c2, c3)

    def log_chances(self, rows: np.ndarray) -> np.ndarray:
        """Log-probabilities of the languages for each window."""
        found = np.empty((len(rows), len(self.languages)), dtype=np.float32)
        f, span = FILTERS, WINDOW_BYTES
        for start in range(0, len(rows), _TOGETHER):
            part = rows[start : start + _TOGETHER]
            codes = part[:, :-1].astype(np.int32) << 8 | part[:, 1:]
            front = self.first[codes]
            two = front[:, :, :f].max(axis=1)
            three = (front[:, : span - 2, f : 2 * f] + self.third[part[:, 2:]]).max(axis=1)
            four = (front[:, : span - 3, 2 * f :] + self.last[codes[:, 2:]]).max(axis=1)
            hidden = np.maximum(np.concatenate([two, three, four], axis=1) + self.bias, 0)
            scores = hidden @ self.output + self.shift
            scores -= scores.max(axis=1, keepdims=True)
            found[start : start + len(part)] = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return found

    def predict(self, texts: Texts) -> tuple[list[str], list[float]]:
        """Language and score of each text, over all its windows."""
        wanted = [k for k, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not wanted:
            return names, scores
        rows = [windows_of(texts[k]) for k in wanted]
        starts = np.cumsum([0, *map(len, rows[:-1])])
        sums = np.add.reduceat(self.log_chances(np.concatenate(rows)).astype(np.float64), starts, axis=0)
        means = sums / np.array([len(r) for r in rows])[:, None]
        chances = np.exp(means - means.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        for k, row in zip(wanted, chances, strict=True):
            best = int(row.argmax())
            names[k], scores[k] = self.languages[best], float(row[best])
        return names, scores


def training_windows(df: DataFrame, key: str, text: str, lang: str, eligible: Column) -> tuple[np.ndarray, list[str]]:
    """Windows of the bounded sample and the language of each; an id counts once, with its smallest language and text."""
    rows = df.where(eligible).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{lang}`").cast("string").alias("_lang"), F.col(f"`{text}`").cast("string").alias("_text"))
    rows = rows.where("_key is not null and _lang is not null and _text is not null")
    ids = rows.groupBy("_key").agg(F.min("_lang").alias("_lang"))
    totals = ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_ids")).orderBy(F.desc("_ids"), "_lang").limit(MOST_LANGUAGES)
    # The smallest hashes of a language all lie in this share of it, but for a chance of some 10 ** -500.
    rank = F.xxhash64("_key").cast("double") / 2.0**64 + 0.5
    low = ids.join(F.broadcast(totals), "_lang").where(rank * F.col("_ids") <= 4 * PER_LANGUAGE)
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key"), "_key")
    sample = low.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= PER_LANGUAGE).select("_key", "_lang")
    texts = rows.join(F.broadcast(sample), ["_key", "_lang"]).groupBy("_key", "_lang").agg(F.min("_text").alias("_text")).select("_lang", "_text")

    def cut_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in slices(batch, 1):
                names, found = [], []
                for name, value in zip(part.column(0).to_pylist(), values, strict=True):
                    if _LETTER.search(value):
                        rows = windows_of(value)
                        for at in np.unique(np.linspace(0, len(rows) - 1, TRAIN_WINDOWS).astype(int)):
                            names.append(name)
                            found.append(rows[at].tobytes())
                yield pa.RecordBatch.from_pydict({"lang": pa.array(names, pa.string()), "bytes": pa.array(found, pa.binary())})

    got = map_arrow(texts, cut_windows, "lang string, bytes binary").toArrow().sort_by([("lang", "ascending"), ("bytes", "ascending")])
    rows = np.frombuffer(b"".join(got.column("bytes").to_pylist()), dtype=np.uint8).reshape(-1, WINDOW_BYTES)
    return rows, got.column("lang").to_pylist()


def train(df: DataFrame, key: str, text: str, lang: str, eligible: Column) -> Tables:
    """A network trained on the bounded sample of eligible rows with a language."""
    rows, names = training_windows(df, key, text, lang, eligible)
    languages = sorted(set(names))
    network = ByteNetwork(languages)
    if languages:
        network.train(rows, np.array([languages.index(x) for x in names]))
    return network.fold()


def held_out(key: str) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(3)) == 1, F.lit(False))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, held_out, lang_pred, score for every row."""
    tables = train(df, key, text, lang, ~held_out(key))
    shared = df.sparkSession.sparkContext.broadcast(tables)

    def make() -> Callable[[Texts], dict[str, list]]:
        return lambda texts: dict(zip(("lang_pred", "score"), shared.value.predict(texts), strict=True))

    found = map_texts(df, key, text, make, "lang_pred string, score double")
    return found.select(key, held_out(key).alias("held_out"), "lang_pred", "score")
