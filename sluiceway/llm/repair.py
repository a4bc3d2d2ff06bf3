"""Repair of conversation structure as lightest derivations over a hypergraph, by Knuth's agenda.

For a conversation of n rows there is an item `Row(i)` for each row and an item `Done(i, state)` for each place and
each state of the role pattern (nothing said, system said, user said, pair complete). An edit is a
deduction: Keep, Rerole and Delete lead from `Done(i, state)` and `Row(i)` to `Done(i + 1, state')`, Insert from
`Done(i, state)` to `Done(i, state')`; `Done(n, state)` of an accepting state leads to the goal. A value is (cost, audit),
ordered by cost and then by the audit text; a deduction adds the edit's cost and appends its initial.
That never makes a value smaller, and keeps the order of two values of the same item, so the value with which an item
leaves the agenda is its least one, and the search ends when the goal leaves it. Audits are nodes of a trie with jump
pointers: they share their beginnings, and two are compared in logarithmic time.

Rows: blank (no word), duplicate (role and text were there before), truncated (the last character that is no space
does not end a sentence); the first of these that holds is a row's fault. Blank and duplicate rows must go,
a truncated one that stays costs more. What remains has roles by the pattern (system? (user assistant)+)? read by initials.
Among all cheapest edits the least audit in ASCII order is taken.

Each conversation's rows meet in one task, sorted by turn (null first; ties by role and text, repeated rows side by side),
one conversation in memory at a time; its audit and repaired rows are one result row. Null roles and texts are one
space. A null conv_id is a conversation of its own. A role without a first character fits nowhere: it is re-roled or
deleted. A conversation without rows after damage has zeros and empty results. An empty table has no result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import map_arrow

#: Costs of edits.
REROLE, DELETE, INSERT, KEPT_TRUNCATED = 1, 2, 5, 5

#: Roles that an edit can give.
GIVEN = ("user", "assistant")

#: What may follow in each state: nothing said, system said, user said, pair complete.
_NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
_ACCEPTS = ("", "a")

_BLANK = re.compile(r"[\x20\x09-\x0D]*")
_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}


# --- the agenda ---------------------------------------------------------------------------------------


class Audits:
    """Texts that share their beginnings: a trie whose nodes know an ancestor far above them."""

    def __init__(self) -> None:
        self._known: dict[tuple[int, str], int] = {}
        self.up, self.jump, self.depth, self.last = [0], [0], [0], [""]

    def append(self, node: int, char: str) -> int:
        found = self._known.get((node, char))
        if found is None:
            found = self._known[node, char] = len(self.up)
            j = self.jump[node]
            far = self.depth[node] - self.depth[j] == self.depth[j] - self.depth[self.jump[j]]
            self.up.append(node)
            self.jump.append(self.jump[j] if far else node)
            self.depth.append(self.depth[node] + 1)
            self.last.append(char)
        return found

    def _raised(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.jump[node] if self.depth[self.jump[node]] >= depth else self.up[node]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the text of a comes before that of b."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._raised(a, depth), self._raised(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        while self.up[x] != self.up[y]:
            if self.jump[x] != self.jump[y]:
                x, y = self.jump[x], self.jump[y]
            else:
                x, y = self.up[x], self.up[y]
        return self.last[x] < self.last[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.last[node])
            node = self.up[node]
        return "".join(reversed(out))


class Value:
    """Cost and audit of a derivation."""

    __slots__ = ("audits", "cost", "node")

    def __init__(self, audits: Audits, cost: int, node: int) -> None:
        self.audits, self.cost, self.node = audits, cost, node

    def __lt__(self, other: "Value") -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        return self.node != other.node and self.audits.less(self.node, other.node)

    def plus(self, cost: int, char: str) -> "Value":
        return Value(self.audits, self.cost + cost, self.audits.append(self.node, char) if char else self.node)


class Deduction(NamedTuple):
    """From items to an item, at a cost and with a letter for the audit. The first premise carries the audit."""

    premises: tuple[Hashable, ...]
    head: Hashable
    cost: int
    letter: str


def lightest(axioms: Iterable[Hashable], deductions: list[Deduction], goal: Hashable) -> tuple[int, str] | None:
    """Least (cost, audit) of a derivation of the goal, by Knuth's generalisation of shortest paths."""
    audits = Audits()
    waiting: list[int] = [len(d.premises) for d in deductions]
    uses: dict[Hashable, list[int]] = {}
    for k, d in enumerate(deductions):
        for premise in d.premises:
            uses.setdefault(premise, []).append(k)
    best: dict[Hashable, Value] = {a: Value(audits, 0, 0) for a in axioms}
    agenda = [(v, k, item) for k, (item, v) in enumerate(best.items())]
    final: dict[Hashable, Value] = {}
    pushed = len(agenda)
    while agenda:
        value, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if item == goal:
            return value.cost, audits.text(value.node)
        for k in uses.get(item, ()):
            waiting[k] -= 1
            if waiting[k]:
                continue
            d = deductions[k]
            first, *others = (final[p] for p in d.premises)
            found = first.plus(d.cost + sum(o.cost for o in others), d.letter)
            if d.head not in final and (d.head not in best or found < best[d.head]):
                best[d.head] = found
                heapq.heappush(agenda, (found, pushed, d.head))
                pushed += 1
    return None


# --- one conversation ---------------------------------------------------------------------------------


class Row(NamedTuple):
    """What repair needs to know of a row: its role's initial and its fault, if any."""

    initial: str
    fault: str | None


def faults(rows: list[tuple[str, str]]) -> list[Row]:
    """The first fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
        end = text.rstrip(_SPACES)
        fault = "blank" if _BLANK.fullmatch(text) else "duplicate" if mark in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add(mark)
        out.append(Row(role[:1], fault))
    return out


def deductions(rows: list[Row]) -> tuple[list[Hashable], list[Deduction], Hashable]:
    """Axioms, deductions and goal for the rows of a conversation."""
    n, goal = len(rows), "goal"
    axioms: list[Hashable] = [("done", 0, ""), *(("row", i) for i in range(n))]
    out: list[Deduction] = []
    for i in range(n + 1):
        for state, after in _NEXT.items():
            here = ("done", i, state)
            out += [Deduction((here,), ("done", i, after[r[0]]), INSERT, "I") for r in GIVEN if r[0] in after]
            if i == n:
                continue
            row, used = rows[i], (here, ("row", i))
            out.append(Deduction(used, ("done", i + 1, state), DELETE, "D"))
            if row.fault in ("blank", "duplicate"):
                continue
            more = KEPT_TRUNCATED if row.fault else 0
            if row.initial and row.initial in after:
                out.append(Deduction(used, ("done", i + 1, after[row.initial]), more, "K"))
            out += [Deduction(used, ("done", i + 1, after[r[0]]), REROLE + more, "R") for r in GIVEN if r[0] in after]
    out += [Deduction((("done", n, state),), goal, 0, "") for state in _ACCEPTS]
    return axioms, out, goal


def applied(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired rows: roles of re-roled and inserted rows follow from the pattern."""
    out: list[tuple[str, str]] = []
    at = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    return out


class Repair(NamedTuple):
    """Result for one conversation."""

    gaps: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str
    repaired: list[tuple[str, str]]


def repair(turns: list[int | None], rows: list[tuple[str, str]]) -> Repair:
    """Faults and cheapest repair of one conversation's rows in order."""
    known = {t for t in turns if t is not None}
    judged = faults(rows)
    count = {f: sum(r.fault == f for r in judged) for f in ("blank", "duplicate", "truncated")}
    illegal = sum(a.initial + b.initial not in _LEGAL for a, b in zip(judged, judged[1:], strict=False))
    found = lightest(*deductions(judged))
    assert found is not None  # deleting everything is always possible
    return Repair(max(known) - min(known) + 1 - len(known) if known else 0, **count, illegal=illegal, cost=found[0], audit=found[1], repaired=applied(rows, found[1]))


# --- Spark --------------------------------------------------------------------------------------------


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by a hash of conversation and turn. A dropped row stays, marked and without text."""
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn))) % 20
    rows = df.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.expr("if(kind = 3, array(1, 2), array(1))")).alias("copy"),
    ).drop("copy")


_OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
_OUT_TYPES = [*(pa.int64() for _ in range(6)), pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]


def _repairer(name: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by conversation and turn."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(conv: pa.Array, turns: list[int | None], rows: list[tuple[str, str]]) -> pa.RecordBatch:
            found = repair(turns, rows)
            cells = [*found[:-1], [{"role": r, "text": t} for r, t in found.repaired]]
            return pa.RecordBatch.from_arrays([conv, *(pa.array([c], t) for c, t in zip(cells, _OUT_TYPES, strict=True))], names=[name, *Repair._fields])

        now, conv, turns, rows = object(), None, [], []
        for batch in batches:
            keys = batch.column("conv_id").to_pylist()
            for k, (key, turn, role, text, dropped) in enumerate(zip(keys, *(batch.column(n).to_pylist() for n in ("turn", "role", "text", "dropped")), strict=True)):
                if key != now:
                    if conv is not None:
                        yield out(conv, turns, rows)
                    now, conv, turns, rows = key, batch.column("conv_id").slice(k, 1), [], []
                if not dropped:
                    turns.append(turn)
                    rows.append((role, text))
        if conv is not None:
            yield out(conv, turns, rows)

    return run


def repair_conversations(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, counts of faults, cost, audit and repaired rows of every conversation, from rows as `damage` returns them."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return map_arrow(dealt, _repairer(key), f"{key} {kind}, {_OUT}")


def repair_digests(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repair of every conversation of `df` after `damage`, with a digest in place of the repaired rows."""
    found = repair_conversations(damage(df, conv, turn, role, text), conv)
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return found.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("repaired")
