"""Quality rules as a short-circuit cascade.

Every rule is a cheap test on a text's measures; a document is rejected by the first rule that fires.
A bounded sample gives each rule's cost and selectivity; rules run in descending order of rejections
per second, which is the best order for independent tests. The order changes the cost and the name of
the rejecting rule, never the verdict: a document is kept when no rule fires.

Nulls and empty texts have no words, so `few_words` rejects them. Repeated rows are judged one by one.
"""

from __future__ import annotations

import string
import time
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import Texts, map_arrow, map_texts, slices

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Thresholds of the further rules: percent of words, letters or lines.
MAX_SYMBOLS_PERCENT = 25
MAX_UPPER_PERCENT = 40
MAX_DUP_LINES_PERCENT = 50
MAX_MEAN_WORD = 40

#: Rows from which the order of the rules is estimated, on average, and the seed of their choice.
SAMPLE_ROWS = 500
SAMPLE_SEED = 9

_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_UPPER = string.ascii_uppercase.encode()
_LOWER = string.ascii_lowercase.encode()


def count_bytes(data: bytes, wanted: bytes) -> int:
    """Bytes of `data` that are among the ASCII characters `wanted`."""
    return len(data) - len(data.translate(None, wanted))


def count_repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more in the text."""
    n = len(words)
    if n <= width:
        return 0
    local: dict[bytes, int] = {}
    ids = np.fromiter((local.setdefault(w, len(local)) for w in words), dtype=np.int64, count=n)
    base, code = len(local), ids[: n - width + 1].copy()
    room = base
    for k in range(1, width):
        if room >= (1 << 62) // base:  # make the codes small again, still exact
            found, code = np.unique(code, return_inverse=True)
            room = len(found)
        code = code * base + ids[k : n - width + 1 + k]
        room *= base
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(code), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = order[twice]
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(change[:n])))


def lines_with_words(data: bytes) -> list[bytes]:
    return [x for x in data.split(b"\n") if x.strip(_SPACES)]


class Measures:
    """A text's measures, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - count_bytes(self.data, _SPACES)

    @cached_property
    def n_symbols(self) -> int:
        return count_bytes(self.data, SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return lines_with_words(self.data)

    @property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return count_repeated_words(self.words)

    @cached_property
    def upper_lower(self) -> tuple[int, int]:
        return count_bytes(self.data, _UPPER), count_bytes(self.data, _LOWER)


def _shouts(m: Measures) -> bool:
    upper, lower = m.upper_lower
    return upper + lower >= 50 and 100 * upper > MAX_UPPER_PERCENT * (upper + lower)


#: Rule name -> does it reject? The first two are the base rules.
RULES: dict[str, Callable[[Measures], bool]] = {
    "few_words": lambda m: m.n_words < MIN_WORDS,
    "repeated_words": lambda m: 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words,
    "symbols": lambda m: 100 * m.n_symbols > MAX_SYMBOLS_PERCENT * m.n_words,
    "upper_case": _shouts,
    "repeated_lines": lambda m: m.n_lines >= 8 and 100 * m.n_dup_lines > MAX_DUP_LINES_PERCENT * m.n_lines,
    "long_words": lambda m: m.word_chars > MAX_MEAN_WORD * m.n_words,
}


def sample_texts(df: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row with the same chance, `rows` of them on average; each task draws from its own rows and none are shuffled."""
    texts, total = df.select(F.col(f"`{text}`").cast("string").alias("_text")), df.count()
    return texts.sample(rows / total, seed=SAMPLE_SEED) if total > rows else texts


def estimate_order(df: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample of about `rows` rows (an empty sample keeps the listed order).

    Each rule is timed on fresh measures: its cost holds all that it must compute when it comes first.
    """

    def trial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent = dict.fromkeys(RULES, 0.0)
        fired = dict.fromkeys(RULES, 0)
        for batch in batches:
            for _, texts in slices(batch, 0):
                for one in texts:
                    for name, rule in RULES.items():
                        began = time.perf_counter()
                        fired[name] += rule(Measures(one))
                        spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(RULES), "spent": [spent[x] for x in RULES], "fired": [fired[x] for x in RULES]})

    got = map_arrow(sample_texts(df, text, rows), trial, "rule string, spent double, fired long").groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("fired").alias("fired")).collect()
    gain = {r["rule"]: r["fired"] / max(r["spent"], 1e-9) for r in got}
    return sorted(RULES, key=lambda x: -gain.get(x, 0.0))


def first_reject(m: Measures, order: list[str]) -> str | None:
    """The first rule in order that rejects; later ones are not computed."""
    return next((name for name in order if RULES[name](m)), None)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, rejected_by: the first rule in the estimated order that rejects the row, null if it is kept."""
    order = estimate_order(df, text)

    def make() -> Callable[[Texts], dict[str, list]]:
        return lambda texts: {"rejected_by": [first_reject(Measures(t), order) for t in texts]}

    return map_texts(df, key, text, make, "rejected_by string")


def measure(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the base measures, base_failed and kept, the cascade's verdict; a rule's measures are shared with the report."""
    order = estimate_order(df, text)
    base = ("few_words", "repeated_words")

    def one(t: str | None) -> tuple:
        m = Measures(t)
        return m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, any(RULES[b](m) for b in base), first_reject(m, order) is None

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    def make() -> Callable[[Texts], dict[str, list]]:
        return lambda texts: dict(zip(names, map(list, zip(*map(one, texts), strict=True)), strict=True))

    return map_texts(df, key, text, make, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns; the order of rules is estimated on a sample."""
    order = estimate_order(df, text)
    at, schema = df.columns.index(text), df.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, at):
                yield part.filter(pa.array([first_reject(Measures(t), order) is None for t in texts], type=pa.bool_()))

    return map_arrow(df, run, schema)
