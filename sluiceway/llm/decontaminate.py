"""Benchmark decontamination by a BM25 index of test items, searched with block-max WAND.

Roles are swapped against web search: the test items are the indexed collection, and every passage of every
training text is a query. Impacts are divided by the item's score for its own text, so a score is the share
of an item that a text holds, and one threshold serves all items. An item is looked for in windows twice as long
as itself that overlap by half, so a copy of it lies whole in one of them. Passages are three times as long as the
longest item and begin every third of that, so each window lies whole in the passage it begins in; they only say
which items to look for, and a verdict does not depend on the lengths of other items.

1. A block of passages is passed over if no item can reach the threshold even with all the block's terms:
   postings of rare terms are added up first and common terms count with all they could give; if that is
   enough for an item, the postings of the block's common terms are added up too. Pairs of passages of the
   blocks that are left go through the same test.
2. Each passage that is left runs through WAND: lists are taken in item order, the pivot is the first
   item whose lists' maxima reach the threshold, maxima of the blocks of postings that hold it can rule it
   out and move the lists past them, and only items that survive are scored.
3. What is retrieved is verified in the item's own windows: one must reach the threshold by itself, and hold
   question and answer (after a marker or question mark, else the last sentence), each by word pairs, or by
   words where there is only one.

Items beyond `INDEX_BYTES` of text are indexed in parts, one after the other, with the document frequencies
of all items. Null and empty texts and items match nothing. Repeated rows are searched one by one.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import map_arrow, slices
from sluiceway.llm.toxicity import tokens_of

#: BM25, and the share of an item's own score from which it is retrieved.
K1, B = 1.2, 0.75
THRESHOLD = 0.45
#: Shares of the question's and the answer's word pairs that a verified passage holds.
QUESTION_SHARE = 0.5
ANSWER_SHARE = 0.5
#: Tokens of a text that are ruled out at once, at least; postings in a block; part of the items that makes a term common.
BLOCK_TOKENS = 512
BLOCK_POSTINGS = 32
COMMON_SHARE = 0.02
#: Text of the items that one index may hold; it is sent to every executor.
INDEX_BYTES = 32 << 20

_ANSWER = re.compile(r"(?i)\banswer\s*:|\?")
_SENTENCE_END = re.compile(r"(?<=[.!?\n])\s+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The two parts of an item; the answer is empty when there is one sentence only."""
    marks = list(_ANSWER.finditer(text))
    if marks and text[marks[-1].end() :].strip():
        return text[: marks[-1].start()], text[marks[-1].end() :]
    sentences = [s for s in _SENTENCE_END.split(text.strip()) if tokens_of(s)]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


def _pairs(tokens: list[bytes]) -> Counter:
    return Counter(zip(tokens, tokens[1:], strict=False)) if len(tokens) > 1 else Counter((t,) for t in tokens)


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of a part's word pairs that the passage holds; 1 for an empty part."""
    wanted = _pairs(part)
    if not wanted:
        return 1.0
    held = _pairs(passage) if len(part) > 1 else Counter((t,) for t in passage)
    return sum((wanted & held).values()) / sum(wanted.values())


class ItemIndex:
    """Postings of the items with normalised BM25 impacts, and maxima of their blocks."""

    def __init__(self, items: list[tuple[object, str]], frequency: dict[bytes, int], n_items: int, mean_length: float):
        self.keys, self.parts, lengths = [], [], []
        self.key_type: pa.DataType | None = None  # as Spark sends the keys; inferred if unset
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for key, text in items:
            tokens = tokens_of(text)
            if not tokens:
                continue
            number = len(self.keys)
            self.keys.append(key)
            self.parts.append(tuple(map(tokens_of, question_and_answer(text))))
            lengths.append(len(tokens))
            impacts = {}
            for term, tf in Counter(tokens).items():
                df = frequency[term]
                weight = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
                impacts[term] = weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(tokens) / mean_length))
            own = sum(impacts.values())
            for term, impact in impacts.items():
                postings.setdefault(term, []).append((number, impact / own))
        self.lengths = lengths
        self.step = max(lengths, default=1)
        self.passage = 3 * self.step
        self.terms = {term: k for k, term in enumerate(sorted(postings))}
        lists = [postings[t] for t in sorted(postings)]
        self.start = np.cumsum([0, *map(len, lists)])
        self.items = np.array([i for x in lists for i, _ in x], dtype=np.int64)
        self.impacts = np.array([w for x in lists for _, w in x])
        self.lists = [[i for i, _ in x] for x in lists]
        self.weights = [[w for _, w in x] for x in lists]
        self.own: list[dict[int, float]] = [{} for _ in self.keys]
        for term, x in enumerate(lists):
            for item, weight in x:
                self.own[item][term] = weight
        self.best = [max(w) for w in self.weights]
        self.block_best = [[max(w[k : k + BLOCK_POSTINGS]) for k in range(0, len(w), BLOCK_POSTINGS)] for w in self.weights]
        self.rare = np.array([len(x) <= max(4, COMMON_SHARE * n_items) for x in lists], dtype=bool)
        common = np.repeat(~self.rare, np.diff(self.start)) if lists else np.zeros(0, dtype=bool)
        self.from_common = np.bincount(self.items[common], weights=self.impacts[common], minlength=len(self.keys)) if lists else np.zeros(0)

    def block_may_match(self, ids: np.ndarray) -> bool:
        """Whether some item can reach the threshold with the terms of a block (ids, -1 for unknown)."""
        known = np.unique(ids)
        known = known[known >= 0]
        rare = self._sums(known[self.rare[known]])
        if not (rare + self.from_common >= THRESHOLD).any():
            return False
        return bool((rare + self._sums(known[~self.rare[known]]) >= THRESHOLD).any())

    def _sums(self, terms: np.ndarray) -> np.ndarray:
        """Impacts of the terms' postings, added up for each item."""
        counts = self.start[terms + 1] - self.start[terms]
        at = np.arange(int(counts.sum())) + np.repeat(self.start[terms] - np.cumsum(counts) + counts, counts)
        return np.bincount(self.items[at], weights=self.impacts[at], minlength=len(self.keys))

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose score for a set of terms reaches the threshold, by block-max WAND."""
        cursors = [[self.lists[t][0], t, 0] for t in terms]  # item, term, place in the list
        heapq.heapify(cursors)
        found = []
        while cursors:
            taken, bound = [], 0.0
            while cursors and bound < THRESHOLD:
                taken.append(heapq.heappop(cursors))
                bound += self.best[taken[-1][1]]
            if bound < THRESHOLD:
                break
            pivot = taken[-1][0]
            while cursors and cursors[0][0] == pivot:
                taken.append(heapq.heappop(cursors))
            tight, block_end = 0.0, float("inf")
            for c in taken:
                self._move(c, pivot)
            taken = [c for c in taken if c[0] is not None]
            for c in taken:
                tight += self.block_best[c[1]][c[2] // BLOCK_POSTINGS]
                last = min((c[2] // BLOCK_POSTINGS + 1) * BLOCK_POSTINGS, len(self.lists[c[1]])) - 1
                block_end = min(block_end, self.lists[c[1]][last])
            target = pivot + 1
            if tight >= THRESHOLD:
                score = sum(self.weights[t][at] for item, t, at in taken if item == pivot)
                if score >= THRESHOLD:
                    found.append((pivot, score))
            else:  # no item up to the nearest block end or the next list's item can do better
                target = max(target, int(min(block_end + 1, cursors[0][0] if cursors else float("inf"))))
            for c in taken:
                self._move(c, target)
                if c[0] is not None:
                    heapq.heappush(cursors, c)
        return found

    def _move(self, cursor: list, target: int) -> None:
        """Move a cursor to the first item that is not before the target; its item becomes None at the end."""
        items, at = self.lists[cursor[1]], cursor[2]
        if cursor[0] is None or cursor[0] >= target:
            return
        while at < len(items) and items[at] < target:
            at += 1
        cursor[0], cursor[2] = (items[at], at) if at < len(items) else (None, at)

    def _passages(self, ids: np.ndarray, first: int, last: int) -> Iterator[int]:
        """Where the passages of a block begin that no pair of neighbours rules out."""
        step = self.step
        for start in range(first, last, 2 * step):
            if self.block_may_match(ids[start : start + step + self.passage]):
                yield from range(start, min(start + 2 * step, last), step)

    def _windows(self, number: int, ids: np.ndarray, start: int) -> Iterator[tuple[int, int, float]]:
        """An item's windows that begin in the first step of a passage and reach the threshold: start, end, score."""
        length, own = self.lengths[number], self.own[number]
        first = -(-start // length)  # windows begin at multiples of the item's length, wherever passages begin
        last = min(-(-(start + self.step) // length), -(-len(ids) // length))
        if first >= last:
            return
        base = first * length
        part = ids[base : (last + 1) * length]
        held: dict[int, set[int]] = {}
        for at in np.flatnonzero(np.isin(part, np.fromiter(own, dtype=np.int64, count=len(own)))).tolist():
            held.setdefault(at // length, set()).add(int(part[at]))
        for k in sorted({x for y in held for x in (y - 1, y) if 0 <= x < last - first}):
            score = math.fsum(own[t] for t in held.get(k, set()) | held.get(k + 1, set()))
            if score >= THRESHOLD:
                yield base + k * length, base + (k + 2) * length, score

    def leaks(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """Verified items of a text: number, best score, overlap of question and answer in the window that holds most of them."""
        if not self.keys or not text:
            return []
        tokens, get = tokens_of(text), self.terms.get
        if not tokens:
            return []
        ids = np.array([get(t, -1) for t in tokens])
        block = max(BLOCK_TOKENS // self.step, 1) * self.step  # blocks begin where passages begin, and reach to the end of the last of theirs
        found: dict[int, tuple[float, float, float]] = {}
        for first in range(0, len(tokens), block):
            if not self.block_may_match(ids[first : first + block - self.step + self.passage]):
                continue
            for start in self._passages(ids, first, min(first + block, len(tokens))):
                own = ids[start : start + self.passage]
                terms = np.unique(own[own >= 0]).tolist()
                for number, _ in self.search(terms):
                    for low, high, score in self._windows(number, ids, start):
                        asked, said = (overlap(p, tokens[low:high]) for p in self.parts[number])
                        if asked >= QUESTION_SHARE and said >= ANSWER_SHARE:
                            best = found.get(number)
                            if best is None or (asked + said, score) > (best[1] + best[2], best[0]):
                                found[number] = (score, asked, said)
        return [(number, *found[number]) for number in sorted(found)]


def build_indexes(items: DataFrame, key: str = "item_id", text: str = "text", index_bytes: int = INDEX_BYTES) -> Iterator[ItemIndex]:
    """Indexes over all items, each within its size; one index unless the items are many."""
    rows = items.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, 1):
                each = [tokens_of(t) for t in texts]
                held = Counter(t for x in each for t in set(x))
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array([*held, None], pa.binary()), "df": pa.array([*held.values(), sum(map(bool, each))], pa.int64()),
                    "length": pa.array([0] * len(held) + [sum(map(len, each))], pa.int64()),
                })

    terms = map_arrow(rows, count, "term binary, df long, length long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length"))
    totals = terms.where("term is null").collect()
    if not totals or not totals[0]["df"]:
        return
    n_items, mean = totals[0]["df"], totals[0]["length"] / totals[0]["df"]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    parts = max(1, -(-size // index_bytes))
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(parts)) == part) if parts > 1 else rows
        held = own.orderBy("key", "text").toArrow()  # within index_bytes
        wanted = terms.where("term is not null")
        if parts > 1:
            wanted = wanted.join(map_arrow(own, count, "term binary, df long, length long").select("term").distinct(), "term")
        frequency = {bytes(r["term"]): r["df"] for r in wanted.select("term", "df").toLocalIterator()}
        index = ItemIndex(list(zip(held.column("key").to_pylist(), held.column("text").to_pylist(), strict=True)), frequency, n_items, mean)
        index.key_type = held.schema.field("key").type
        yield index


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item key, score, question_overlap, answer_overlap: a row for each text and each item it holds."""
    spark = docs.sparkSession
    picked = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    kinds = {n: items.schema[n].dataType.simpleString() for n in (item_key,)}
    schema = f"_key {docs.schema[key].dataType.simpleString()}, _item {kinds[item_key]}, score double, question_overlap double, answer_overlap double"
    result = spark.createDataFrame([], schema)
    for index in build_indexes(items, item_key, item_text):
        result = result.unionByName(map_arrow(picked, _finder(spark.sparkContext.broadcast(index)), schema))
    return result.withColumnsRenamed({"_key": key, "_item": item_key})


def _finder(shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part, texts in slices(batch, 1):
                rows = [(k, *hit) for k, t in enumerate(texts) for hit in index.leaks(t)]
                if rows:
                    which, numbers, scores, asked, said = map(list, zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(which)), pa.array([index.keys[n] for n in numbers], index.key_type), *(pa.array(x, pa.float64()) for x in (scores, asked, said))],
                        names=["_key", "_item", "score", "question_overlap", "answer_overlap"],
                    )

    return run


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows whose text holds no item, with all their columns."""
    at, result = docs.columns.index(text), docs
    for index in build_indexes(items, item_key, item_text):
        result = map_arrow(result, _keeper(docs.sparkSession.sparkContext.broadcast(index), at), docs.schema)
    return result


def _keeper(shared, at: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, at):
                yield part.filter(pa.array([not shared.value.leaks(t) for t in texts], type=pa.bool_()))

    return run
