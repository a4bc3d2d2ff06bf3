import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import queries, repair

PATTERN = re.compile("(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_faults(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        found = WORD.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in rows[:i] else "truncated" if found[-1] not in ".!?" else None)
    return out


def every_repair(rows, most_inserts):
    """(cost, audit, repaired) of all edits, by enumeration."""
    options = []
    for (role, text), fault in zip(rows, plain_faults(rows), strict=True):
        stay = 5 if fault == "truncated" else 0
        options.append([(2, "D", None)] + ([] if fault in ("blank", "duplicate") else [(stay, "K", (role, text)), (1 + stay, "R", ("user", text)), (1 + stay, "R", ("assistant", text))]))
    inserted = [(5, "I", ("user", "")), (5, "I", ("assistant", ""))]
    gaps = [g for k in range(most_inserts + 1) for g in itertools.product(inserted, repeat=k)]
    for chosen in itertools.product(*options):
        for filling in itertools.product(gaps, repeat=len(rows) + 1):
            if sum(map(len, filling)) > most_inserts:
                continue
            steps = [*filling[0], *itertools.chain.from_iterable([c, *f] for c, f in zip(chosen, filling[1:], strict=True))]
            kept = [s[2] for s in steps if s[2]]
            if all(r for r, _ in kept) and PATTERN.fullmatch("".join(r[0] for r, _ in kept)):
                yield sum(s[0] for s in steps), "".join(s[1] for s in steps), kept


def by_prefix(rows):
    """The same optimum by a left-to-right table, for longer conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    better = lambda a, b: b if a is None else min(a, b)

    def close(table):
        for _ in range(6):
            for (state, said), after in step.items():
                if state in table and said in "ua":
                    c, a = table[state]
                    table[after] = better(table.get(after), (c + 5, a + "I"))
        return table

    table = close({"": (0, "")})
    for (role, _), fault in zip(rows, plain_faults(rows), strict=True):
        new = {}
        for state, (c, a) in table.items():
            new[state] = better(new.get(state), (c + 2, a + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            for cost, letter, said in ((0, "K", role[:1]), (1, "R", "u"), (1, "R", "a")):
                after = step.get((state, said))
                if after:
                    new[after] = better(new.get(after), (c + cost + more, a + letter))
        table = close(new)
    return min(table[s] for s in ("", "a") if s in table)


def damaged(rows):
    """Rows (conv, turn, role, text) after damage, by conversation and in order."""
    out = {}
    spaced = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        here = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def expected(rows):
    out = []
    for conv, here in damaged(rows).items():
        said = [(r, t) for _, r, t in here]
        known = {t for t, _, _ in here if t is not None}
        found = plain_faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        cost, audit = by_prefix(said)
        kept = repair.applied(said, audit)
        assert PATTERN.fullmatch("".join(r[0] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out.append((conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = queries.QUERIES["op12_structure_repair"](spark, sf)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", " "]), st.sampled_from(["", " \n", "Yes.", "No!", "cut off", "also cut"])), max_size=3)


@settings(max_examples=150, deadline=None)
@given(ROWS)
def test_least_of_all_edits(rows):
    found = repair.repair([None] * len(rows), rows)
    options = list(every_repair(rows, 2))
    cost, audit = min(o[:2] for o in options)
    assert (found.cost, found.audit) == (cost, audit)
    assert all(o[2] == found.repaired for o in options if o[:2] == (cost, audit))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x"]), st.sampled_from(["", "Yes.", "No.", "cut", "a b.", "c"])), max_size=24))
def test_least_of_longer_ones(rows):
    found = repair.repair([None] * len(rows), rows)
    assert (found.cost, found.audit) == by_prefix(rows)


def test_agenda_takes_deductions_with_several_premises():
    D = repair.Deduction
    rules = [D(("a", "b"), "c", 1, "x"), D(("a",), "c", 1, "y"), D(("c", "b"), "goal", 2, "z"), D(("never",), "goal", 0, "")]
    assert repair.lightest(["a", "b"], rules, "goal") == (3, "xz")
    assert repair.lightest(["a"], rules, "goal") is None


def test_audits_compare_as_texts():
    rng, audits = random.Random(3), repair.Audits()
    texts = ["".join(rng.choice("DIKR") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [t + "K" for t in texts]
    nodes = []
    for t in texts:
        node = 0
        for c in t:
            node = audits.append(node, c)
        nodes.append(node)
    for (a, x), (b, y) in itertools.product(zip(texts, nodes, strict=True), repeat=2):
        assert audits.less(x, y) == (a < b)
    assert [audits.text(n) for n in nodes] == texts


def test_a_long_conversation():
    rng = random.Random(9)
    rows = [(rng.choice(["user", "assistant"]), f"turn {k}" + rng.choice([".", ""])) for k in range(3000)]
    found = repair.repair(list(range(3000)), rows)
    assert (found.cost, found.audit) == by_prefix(rows)


def test_odd_rows(spark):
    rows = [(1, k, "user", "Hello.") for k in range(12)] + [(1, 3, "user", "Hello."), (1, None, None, None), (1, None, "system", "S."), (None, 1, "user", "x."), (None, None, "assistant", "y")]
    rows += [(c, None, None, None) for c in range(50, 90)] + [(c, c, "", "word.") for c in range(100, 130)] + [(2, 5, "user", "long " * 50_000), (2, 1 << 40, "assistant", "fine.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, kind int").repartition(4)
    got = repair.repair_digests(df)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
    assert repair.repair_digests(df.limit(0)).collect() == []


def test_repaired_rows_are_returned(spark):
    rows = spark.createDataFrame([("c", 1, "assistant", "Hi.", False), ("c", 2, "user", "cut", False), ("d", 1, "user", "gone", True)], "conv_id string, turn int, role string, text string, dropped boolean")
    got = {r.conv_id: r for r in repair.repair_conversations(rows).collect()}
    assert (got["d"].cost, got["d"].audit, got["d"].repaired) == (0, "", [])
    assert [tuple(r) for r in got["c"].repaired] == [] and got["c"].audit == "DD"


@pytest.mark.parametrize(("rows", "audit"), [([], ""), ([("user", "A.")], "D"), ([("user", "A."), ("user", "B."), ("assistant", "C.")], "DKK"), ([("system", "S."), ("user", "A."), ("assistant", "B.")], "KKK")])
def test_small_cases(rows, audit):
    assert repair.repair([], rows).audit == audit


def test_sql_gives_the_same(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.ORACLES['op12_structure_repair']})").fetchall()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert sorted(want, key=str) == expected(rows)
