import hashlib
import random
import zlib

import duckdb

from sluiceway.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            mark = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, (role or "").encode(), mark), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def expected(convs):
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for p, of in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in of if len(convs[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        leaves = sum(1 for q in below if not any(r[: len(q)] == q and len(r) == len(q) + 1 for r in below))
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), sum(len(q) == len(p) + 1 for q in below), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = queries.QUERIES["op13_prefix_trie"](spark, sf)
    assert got.columns == COLUMNS
    assert result(got) == expected(rebuilt(rows))


def some_rows():
    """Shared beginnings, exact copies, a long chain, nulls in every column, ties, repeated rows, a head whose group has no first conversation."""
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 30), *range(100, 130), *range(205, 215), -7, -100, -130]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["one", "two ü", "😀 three"]) if t else "hello"))
    rows += [(500, t, "user", f"turn {t}") for t in range(60)] + [(501, t, "user", f"turn {t}") for t in range(60)]
    rows += [(600, None, "user", "null turn"), (600, None, None, None), (600, 1, "user", None), (600, 1, "user", None), (600, 1, None, "x"), (None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(700, 1, "user", "long " * 40_000)] + [(c, 0, "user", "the same") for c in range(800, 860)]
    return rows


def test_odd_rows(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int").repartition(5)
    assert result(prefix_trie.rebuilt_trie(df)) == expected(rebuilt(rows))
    assert prefix_trie.rebuilt_trie(df.limit(0)).collect() == []


def test_depth_by_depth_and_in_blocks(spark, monkeypatch):
    """However depths are put together, the nodes are the same."""
    rows = [r for r in some_rows() if r[0] is not None and r[0] < 500 or r[0] in (600, 700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = expected(rebuilt(rows))
    for most in (1, 40):
        monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", most)
        assert result(prefix_trie.rebuilt_trie(df)) == want


def test_blocks_are_bounded():
    blocks = prefix_trie._blocks({399: 2, 300: 1, 8: 30_000, 3: 5})
    turns = {d: sum(n for k, n in {399: 2, 300: 1, 8: 30_000, 3: 5}.items() if k >= d) for d in range(1, 400)}
    assert [d for high, low in blocks for d in range(high, low - 1, -1)] == list(range(399, 0, -1))
    assert all(high == low or sum(turns[d] for d in range(low, high + 1)) <= prefix_trie.BLOCK_TURNS for high, low in blocks)
    assert len(blocks) == 9 and prefix_trie._blocks({}) == [] and prefix_trie._blocks({0: 4}) == []


def test_sql_gives_the_same(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.ORACLES['op13_prefix_trie']})").fetchall()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert sorted(want, key=str) == expected(rebuilt(rows))
