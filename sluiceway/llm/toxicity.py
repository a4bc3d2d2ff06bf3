"""Toxicity by maximum-scoring segments of token log-odds.

Learning, on at most `SAMPLE_DOCS` labelled documents (those with the smallest hashed ids, none of them held
out): the forms of a token are itself and its first 4 to 7 bytes, so that inflected words share evidence. For
each label the documents that hold a form are counted, so a burst in one document weighs little. A form's
log-odds between the labels get a Dirichlet prior in proportion to its overall frequency; forms whose counts
differ significantly score their log-odds less ERRORS_OFF standard errors. A token scores as its best form,
or 0, and every token pays a constant, so an ordinary text drifts downwards.

Scoring: a linear-time scan finds all maximal scoring segments of a text (no prefix or suffix of one has a
negative sum, none can be extended). Their chance under ordinary text follows an extreme-value law whose
decay solves E[exp(decay * score)] = 1 over the tokens of non-toxic documents: a segment of score S is
expected K * n * exp(-decay * S) times in n tokens. The evidence of all significant segments is added up and
turned into a probability by a logistic curve, fitted on labelled documents that took no part in the counts.

Null and empty texts have no segment and get the curve's value for no evidence. Without both labels in the
sample every score is 0. A document with contradicting labels counts as toxic.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Texts, cut, map_arrow, map_texts, slices

#: Labelled documents to learn from.
SAMPLE_DOCS = 20_000
#: Weight of the Dirichlet prior in documents, standard errors taken off, constant paid for a token.
PRIOR_DOCS = 20.0
ERRORS_OFF = 2.0
TOKEN_COST = 0.1
#: Twice the log-likelihood ratio from which a form's counts differ by label; millions of forms are tested.
LEAST_RATIO = 20.0
#: Least score of a form: weaker ones, ever so significant, say little about a document.
LEAST_SCORE = 1.5
#: Lengths of a token's prefixes that count as forms.
PREFIXES = range(4, 8)
#: Tokens whose score a process keeps; beyond it the table is filled anew.
CACHE_TOKENS = 200_000
#: Expected count in a document of ordinary text under which a segment is significant.
SIGNIFICANT = 0.05
#: Score from which a document is predicted toxic (fixed value of the contract).
PREDICT = 0.3

#: A-Z to lower case, other ASCII characters but digits and the apostrophe to a space; UTF-8 bytes stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c == 39 else 32 for c in range(256))


def tokens_of(text: str | None) -> list[bytes]:
    """Tokens: runs of letters, digits, apostrophes and non-ASCII bytes, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def forms_of(token: bytes) -> list[bytes]:
    """The token, marked as whole, and its prefixes."""
    return [token + b"$", *[token[:k] for k in PREFIXES if k <= len(token)]]


def maximal_segments(positions: list[int], scores: list[float], cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence given by its positive items.

    Item k stands at positions[k] and adds scores[k]; each step between items costs `cost`. Returns (first
    item, last item, sum), in linear time: each candidate keeps the running total before (low) and after
    (high) it, and one that a later, higher total can absorb is merged with all that lie between.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, low, high, index of the nearest candidate with a lower low
    total, at = 0.0, None
    for k, (place, gain) in enumerate(zip(positions, scores, strict=True)):
        if at is not None:
            total -= cost * (place - at - 1)
        at = place
        first, low = k, total
        total += gain
        high = total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, k, low, high, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, high - low) for first, last, low, high, _ in found]


class Lexicon:
    """Token scores, the constants of the extreme-value law, and the curve from evidence to probability."""

    def __init__(self, forms: dict[bytes, float], decay: float = 1.0, rate: float = 1.0, curve: tuple[float, float] = (-3.0, 2.0), usable: bool = True):
        self.forms, self.decay, self.rate, self.curve, self.usable = forms, decay, rate, curve, usable
        self._known: dict[bytes, float] = {}

    def score(self, token: bytes) -> float:
        """A token's score: its best form's, 0 without one."""
        found = self._known.get(token)
        if found is None:
            found = max([self.forms.get(f, 0.0) for f in forms_of(token)])
            if len(self._known) >= CACHE_TOKENS:
                self._known.clear()
            self._known[token] = found
        return found

    def hits(self, tokens: list[bytes]) -> list[tuple[int, float]]:
        """Places and scores of the tokens that score."""
        if not self.forms:
            return []
        scores = {t: s for t in set(tokens) if (s := self.score(t))}
        return [(i, scores[t]) for i, t in enumerate(tokens) if t in scores] if scores else []

    def segments(self, tokens: list[bytes]) -> list[tuple[int, int, float]]:
        """First token, last token and evidence of every significant segment."""
        hits = self.hits(tokens)
        if not hits:
            return []
        places = [i for i, _ in hits]
        expected = math.log(max(self.rate * len(tokens), 1e-9))
        found = []
        for first, last, total in maximal_segments(places, [s for _, s in hits], TOKEN_COST):
            evidence = self.decay * total - expected
            if evidence > -math.log(SIGNIFICANT):
                found.append((places[first], places[last], evidence))
        return found

    def evidence(self, text: str | None) -> float:
        """Evidence of all significant segments, on a scale that grows slowly."""
        return math.log1p(sum(e for _, _, e in self.segments(tokens_of(text))))

    def chance(self, evidence: float) -> float:
        if not self.usable:
            return 0.0
        base, slope = self.curve
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, base + slope * evidence))))


def solve_decay(scores: np.ndarray, counts: np.ndarray, plain: float) -> float:
    """The positive root of E[exp(decay * score)] = 1; `plain` tokens score -TOKEN_COST."""
    total = counts.sum() + plain

    def excess(x: float) -> float:
        return (counts * np.exp(np.minimum(x * scores, 600))).sum() / total + plain / total * math.exp(-x * TOKEN_COST) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(high, 1e-3)


def fit_curve(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps, with a light pull to 0."""
    x = np.stack([np.ones_like(evidence), evidence], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - label) + 0.05 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curvature, gradient), -3, 3)
    return float(w[0]), float(max(w[1], 0.0))


def _fold(key: str) -> Column:
    return F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(4))


def held_out(key: str) -> Column:
    """Rows that learning never sees: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(_fold(key) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Lexicon:
    """The lexicon from the bounded labelled sample: folds 0 and 1 are counted, fold 3 fits the curve.

    Labels other than 0 and 1 are no labels; the larger one counts where a key has both.
    """
    stated = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("double").alias("_toxic")).where(F.col("_key").isNotNull() & F.col("_toxic").isin(0.0, 1.0) & ~held_out("_key"))
    known = stated.groupBy("_key").agg(F.max(F.col("_toxic").cast("int")).alias("_toxic"))
    sample = known.orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_DOCS)
    texts = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text")).join(F.broadcast(sample), "_key")
    texts = cut(texts.select("_toxic", (_fold("_key") == 3).alias("_fit"), "_text"))
    sizes = {r["_toxic"]: r["count"] for r in texts.where("not _fit").groupBy("_toxic").count().collect()}
    forms = significant_forms(texts.where("not _fit"), sizes.get(1, 0), sizes.get(0, 0))
    if not forms:
        return Lexicon({}, usable=False)
    sent = docs.sparkSession.sparkContext.broadcast(Lexicon(forms))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[float] = Counter()
        for batch in batches:
            for _, values in slices(batch, 2):
                for value in values:
                    tokens = tokens_of(value)
                    hits = sent.value.hits(tokens)
                    counts.update(round(s, 2) for _, s in hits)
                    counts[0.0] += len(tokens) - len(hits)
        yield pa.RecordBatch.from_pydict({"score": pa.array(list(counts), pa.float64()), "n": pa.array(list(counts.values()), pa.int64())})

    clean = map_arrow(texts.where("not _fit and _toxic = 0"), spread, "score double, n long").groupBy("score").agg(F.sum("n").alias("n")).orderBy("score").toArrow()
    scores, counts = (np.array(clean.column(c).to_pylist(), dtype=float) for c in ("score", "n"))
    plain, hit = float(counts[scores == 0].sum()), scores > 0
    # Half an imagined hit on every form keeps the law defined when ordinary text has no hits at all.
    values = np.concatenate([scores[hit], list(forms.values())])
    weights = np.concatenate([counts[hit], np.full(len(forms), 0.5 / len(forms))])
    decay = solve_decay(values - TOKEN_COST, weights, plain + 1)
    rate = float(weights.sum() / (plain + weights.sum() + 1))  # K: how often a token of ordinary text starts a segment
    draft = docs.sparkSession.sparkContext.broadcast(Lexicon(forms, decay, rate))

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in slices(batch, 2):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([draft.value.evidence(v) for v in values], pa.float64())], names=["toxic", "evidence"])

    fitted = map_arrow(texts.where("_fit"), weigh, "toxic int, evidence double").groupBy("toxic", F.round("evidence", 3).alias("evidence")).count().toArrow()
    label_of, x, n = (np.array(fitted.column(c).to_pylist(), dtype=float) for c in ("toxic", "evidence", "count"))
    if not len(n) or label_of.min() == label_of.max():
        return Lexicon(forms, decay, rate)
    order = np.lexsort((x, label_of))
    curve = fit_curve(np.repeat(x[order], n[order].astype(int)), np.repeat(label_of[order], n[order].astype(int)))
    return Lexicon(forms, decay, rate, curve)


def significant_forms(texts: DataFrame, n1: int, n0: int) -> dict[bytes, float]:
    """Forms whose document counts differ by label, with their scores; only these reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in slices(batch, 2):
                counts = (Counter(), Counter())
                for toxic, value in zip(part.column(0).to_pylist(), values, strict=True):
                    counts[toxic].update({f for t in set(tokens_of(value)) for f in forms_of(t)})
                for toxic in (0, 1):
                    yield pa.RecordBatch.from_pydict({"form": pa.array(list(counts[toxic]), pa.binary()), "toxic": pa.array([toxic] * len(counts[toxic]), pa.int32()), "n": pa.array(list(counts[toxic].values()), pa.int64())})

    counted = map_arrow(texts, count, "form binary, toxic int, n long").groupBy("form").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0")
    )
    if not n1 or not n0:
        return {}
    prior = f"({PRIOR_DOCS} * (y1 + y0) / {n1 + n0} + 0.5)"
    odds = f"ln((y1 + {prior}) / ({n1 + PRIOR_DOCS} - y1)) - ln((y0 + {prior}) / ({n0 + PRIOR_DOCS} - y0))"
    error = f"sqrt(1 / (y1 + {prior}) + 1 / (y0 + {prior}))"
    e1, e0 = f"((y1 + y0) * {n1 / (n1 + n0)})", f"((y1 + y0) * {n0 / (n1 + n0)})"
    ratio = f"2 * (y1 * ln(y1 / {e1}) + if(y0 > 0, y0 * ln(y0 / {e0}), 0))"
    strong = counted.where(f"y1 > {e1} and {ratio} >= {LEAST_RATIO}").selectExpr("form", f"{odds} - {ERRORS_OFF} * {error} as score").where(F.col("score") >= LEAST_SCORE)
    rows = strong.orderBy("form").toArrow()
    return dict(zip(rows.column("form").to_pylist(), rows.column("score").to_pylist(), strict=True))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """key, held_out, score, predicted, n_segments, segments (first-last token of each significant one) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, key, text, label))

    def make() -> Callable[[Texts], dict[str, list]]:
        lexicon = shared.value

        def work(texts: Texts) -> dict[str, list]:
            found = [lexicon.segments(tokens_of(t)) for t in texts]
            chances = [lexicon.chance(math.log1p(sum(e for _, _, e in f))) for f in found]
            return {
                "score": chances, "predicted": [int(c >= PREDICT) for c in chances], "n_segments": [len(f) for f in found],
                "segments": [",".join(f"{a}-{b}" for a, b, _ in f) for f in found],
            }

        return work

    found = map_texts(docs, key, text, make, "score double, predicted int, n_segments int, segments string")
    return found.select(key, held_out(key).alias("held_out"), "score", "predicted", "n_segments", "segments")
