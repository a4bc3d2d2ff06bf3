import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import jaccard, queries


def brute(rows):
    """doc_id -> (shingles, smallest linked doc_id) by comparing all pairs that share a shingle."""
    sets = {}
    for key, text in rows:
        words = [w.lower() for w in (text or "").encode().split()]
        sets[key] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def make_rows(seed, groups=12, size=9):
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 5, 8, 40, 120]))]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 50)}"
            if rng.random() < 0.4:
                words = words + passage
            rows.append((len(rows) * 7 % 1000 + 1000 * (len(rows) // 1000), " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = make_rows(seed)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_chain_of_links(spark):
    """Each text links with its neighbours only; the whole chain is one component."""
    words = [f"w{k}" for k in range(400)]
    rows = [(100 - k, " ".join(words[6 * k : 6 * k + 60])) for k in range(30)]
    want = brute(rows)
    assert len({c for _, c in want.values()}) == 1
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_exact_threshold(spark):
    """Similarity of exactly 0.75 links, a shade less does not."""
    def doc(k, n):  # n shingles, the first k of them common to all
        return " ".join([f"c{i}" for i in range(k + 4)] + [f"{n}_{k}_{i}" for i in range(n - k)])
    rows = [(1, doc(12, 14)), (2, doc(12, 14) .replace("14_12", "z")), (3, " ".join(f"d{i}" for i in range(10))), (4, " ".join(f"d{i}" for i in range(9)))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and got[1][1] == got[2][1] == 1


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_fragments_find_all_shared_shingles(bits, monkeypatch):
    """Packing, joining fragments and merging buckets, without Spark, against plain counting."""
    monkeypatch.setattr(jaccard, "PACKED", 300)
    rows = [t for _, t in make_rows(7)] + [None, "", "a b"]
    shingle = jaccard.Shingler()
    sets = {jaccard.set_id(s): s for s in map(shingle, rows) if len(s)}
    counts = {}
    for s in sets.values():
        for x in s.tolist():
            counts[x] = counts.get(x, 0) + 1
    want = {k: sorted(jaccard._reduced(np.array([x for x in s.tolist() if counts[x] > 1], dtype=np.uint64), bits).view(np.int64).tolist()) for k, s in sets.items()}
    tasks = [rows[k::3] for k in range(3)]
    packed = [b for part in tasks for b in jaccard._packer(bits)([pa.RecordBatch.from_pydict({"t": pa.array(part, pa.string())})])]
    dealt = pa.Table.from_batches(packed).sort_by("fragment").to_batches(max_chunksize=7)
    lists = pa.Table.from_batches(list(jaccard._fragment_joiner(bits)(dealt))).sort_by("bucket").to_batches(max_chunksize=5)
    got = {k: h for b in jaccard._merge_buckets(lists) for k, h in zip(b.column("set_id").to_pylist(), b.column("held").to_pylist(), strict=True)}
    assert got == {k: v for k, v in want.items() if v}


def test_large_group_of_copies_and_fragments(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FRAGMENT", 64)
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(150):
        words = list(base)
        words[rng.randrange(60)] = f"y{k}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(base)) for k in range(40)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_signatures_with_shingles_of_a_set_that_leaves(spark):
    """What two linked texts share with a third one that links with nothing takes nothing off their overlap."""
    rows = []
    for k in range(8):
        common, tails = [f"c{k}_{i}" for i in range(34)], [[f"t{k}_{j}_{i}" for i in range(5)] for j in range(2)]
        rows += [(10 * k + j, " ".join(common + tail)) for j, tail in enumerate(tails)]
        rows.append((10 * k + 2, " ".join(w for j, tail in enumerate(tails) for w in [*common[-4:], *tail, *(f"f{k}_{j}_{i}" for i in range(200))])))
    want = brute(rows)
    assert all(want[10 * k + 1][1] == 10 * k and want[10 * k + 2][1] == 10 * k + 2 for k in range(8))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_only_sets_that_can_link_pack_the_rest(monkeypatch):
    """The low part comes with a row for every document; above it only texts of wanted keys are packed."""
    texts = [" ".join(f"w{k}_{i}" for i in range(50)) for k in range(6)] + [None, "a b"]
    batch = pa.RecordBatch.from_pydict({"k": pa.array([*range(7), None], pa.int64()), "t": pa.array(texts, pa.string())})
    shingle = jaccard.Shingler()
    sets = {jaccard.set_id(s): s for s in map(shingle, texts) if len(s)}
    size = lambda batches: sum(len(a) for b in batches for a in b.column("alone").to_pylist() if a) // jaccard.PACKED_BYTES
    low = list(jaccard._low_packer(2)([batch]))
    documents = [r for b in low for r in b.to_pylist() if r["n_shingles"] is not None]
    assert [(r["_key"], r["n_shingles"]) for r in documents] == [*((k, 46) for k in range(6)), (6, 0), (None, 1)]
    assert size(low) == sum(r["n_low"] for r in documents) == sum(int((s < jaccard.LOW).sum()) for s in sets.values())
    wanted = np.zeros(2, dtype=np.uint8)
    wanted[1] |= 1 << 3  # place 11
    again = pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string()), "p": pa.array([11, *range(1, 8)], pa.int64())})
    assert size(jaccard._packer(2, wanted)([again])) == int((shingle(texts[0]) >= jaccard.LOW).sum())


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op3_ngram_jaccard"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_odd_rows(odd, odd_rows, empty):
    got = jaccard.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].n_shingles == 0 and by_id[3].component_id == 3 and by_id[6].component_id == 6
    assert by_id[2].component_id == 1 and by_id[9].component_id == 1 and by_id[7].n_shingles == 1
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    assert jaccard.near_duplicates(empty).count() == 0


def test_no_text_goes_because_its_key_repeats(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, a), (1, b), (2, b), (3, a), (3, a), (4, a + " more"), (5, None), (5, ""), (5, "x"), (6, b), (None, a), (None, a)]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, a), (1, a), (1, b), (5, ""), (5, "x")]


def test_signatures_never_hide_a_link():
    """Taking off the bits of one set that the other lacks never goes below the true overlap."""
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (3, 40, 400, 4000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 4 // 5], rng.integers(0, 1 << 62, len(s) // 5, dtype=np.uint64)])) for s in sets]
    lists = [(np.array([k], dtype=np.int64).tobytes(), np.array([len(s)], dtype=np.int32).tobytes(), s.astype("<u8").tobytes()) for k, s in enumerate(sets)]
    bits = {r["set_id"]: r["signature"] for r in jaccard._merge_bucket(lists).to_pylist()}
    for i, j in itertools.permutations(range(len(sets)), 2):
        lacking = sum((x & ~y & (1 << 64) - 1).bit_count() for x, y in zip(bits[i], bits[j], strict=True))
        assert len(np.intersect1d(sets[i], sets[j])) <= len(sets[i]) - lacking


def test_estimates_do_not_grow_in_a_loop_of_joins(spark):
    """The driver's estimate of a frame that is joined and written again and again keeps its digits: a checkpoint's doubled them each time."""
    frame = spark.createDataFrame([(1, 2), (2, 2)], "node long, to long")
    for _ in range(4):
        further = frame.select(F.col("node").alias("to"), F.col("to").alias("further"))
        frame = jaccard._dense(frame.join(further, "to").select("node", F.col("further").alias("to")), 2)
    assert sorted(map(tuple, frame.collect())) == [(1, 2), (2, 2)]
    assert frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 100


@pytest.mark.parametrize("block", [7, 4096])
def test_open_pairs_are_those_of_all_pairs(spark, block, monkeypatch):
    """Groups compared in blocks give each pair of different components that can link, and no other."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(3)
    sets, entries = {}, []
    for k in range(60):
        n = rng.randint(8, 14)
        words = [-1 if rng.random() < 0.7 else rng.getrandbits(63) for _ in range(jaccard.SIGNATURE)]
        sets[k] = (n, rng.randint(n - 2, n), rng.choice([0, 0, 0, *range(1, 9)]), words, n if k % 3 else 1024)
    for shingle in range(5):
        entries += [(shingle, k) for k in sets if shingle == 0 or rng.random() < 0.3]
    entries += [(9, 3), (9, 4), (-5, 1)]

    def can_link(a, b):
        (n, shared, label, words, signed), (n_b, shared_b, label_b, words_b, signed_b) = sets[a], sets[b]
        lacks = lambda x, y: sum((u & ~v & (1 << 64) - 1).bit_count() for u, v in zip(x, y, strict=True))
        return label != label_b and min(7 * min(shared, shared_b), 7 * min(signed - lacks(words, words_b), signed_b - lacks(words_b, words))) >= 3 * (n + n_b)

    want = {(a, b) for s in {s for s, _ in entries} for a, b in itertools.combinations(sorted(k for t, k in entries if t == s), 2) if can_link(a, b)}
    labelled = spark.createDataFrame([(s, k, *sets[k][:3]) for s, k in entries], "shingle long, set_id long, n int, shared int, label long")
    signatures = spark.createDataFrame([(k, v[3], v[4]) for k, v in sets.items()], "set_id long, signature array<long>, signed int")
    got = [tuple(r) for r in jaccard.open_pairs(labelled, signatures).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_compared_piece_by_piece(monkeypatch):
    """The pieces in which a group is compared change nothing, with sides and without."""
    rng = np.random.default_rng(5)
    k = 40
    group = {"label": rng.integers(0, 6, k), "n": rng.integers(9, 13, k), "shared": np.full(k, 11), "signed": rng.integers(9, 13, k), "side": np.zeros(k, dtype=np.int64)}
    group["signature"] = (np.uint64(1) << rng.integers(0, 3, (k, jaccard.SIGNATURE), dtype=np.uint64))
    for sides in (group["side"], rng.integers(0, 2, k)):
        found = []
        for cells in (1, 50, 1 << 15):
            monkeypatch.setattr(jaccard, "COMPARED", cells)
            found.append(sorted(tuple(sorted(p)) for i, j in jaccard._compare(group | {"side": sides}) for p in zip(i.tolist(), j.tolist(), strict=True)))
        assert found[0] == found[1] == found[2] == sorted(set(found[0]))
        assert all(group["label"][a] != group["label"][b] and (sides is group["side"] or sides[a] != sides[b]) for a, b in found[0])


@pytest.mark.parametrize("edges", [0, 1 << 20])
def test_components_of_links(spark, edges, monkeypatch):
    """Components are the same whether one task follows the edges or frames do."""
    monkeypatch.setattr(jaccard, "EDGES", edges)
    rng = random.Random(4)
    names = [rng.getrandbits(64) - (1 << 63) for _ in range(80)]
    links = [(names[k], names[k + 1]) for k in range(30)] + [(names[rng.randrange(40, 70)], names[rng.randrange(40, 70)]) for _ in range(25)]
    want = {k: k for k in names}
    for _ in names:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    labels = spark.createDataFrame([(k, k) for k in names], "set_id long, label long")
    once = jaccard.merge_components(labels, spark.createDataFrame(links[:20], "a long, b long"))
    got = jaccard.merge_components(once, spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted(want.items())


def test_counts_of_lists_are_summed(monkeypatch):
    """A set in several lists of a task comes out once, or once for each full load, with the same sum."""
    lists = [([3, -2, 7], [1, 2, 3]), ([-2], [5]), ([7, 3], [1, 1])]
    rows = [(np.array(names, dtype=np.int64).tobytes(), np.array(counts, dtype=np.int32).tobytes()) for names, counts in lists]
    batches = [pa.RecordBatch.from_pydict({"names": [r[0]], "counts": [r[1]]}) for r in rows]
    for held, most in ((jaccard.PACKED, 3), (4, 5)):
        monkeypatch.setattr(jaccard, "PACKED", held)
        got = [r for b in jaccard._count_lists(batches) for r in b.to_pylist()]
        sums = {k: sum(r["shared"] for r in got if r["set_id"] == k) for k in (-2, 3, 7)}
        assert sums == {-2: 7, 3: 2, 7: 4} and len(got) == most
    assert list(jaccard._count_lists([])) == []


def test_prefix_entries_hold_what_lies_ahead(spark):
    """Each further shingle of a prefix leaves one shared shingle less, and all linked pairs still meet."""
    rng = random.Random(6)
    rows = [(k, 40, sorted(rng.sample(range(38), 36))) for k in range(12)]
    got = jaccard.prefixes(spark.createDataFrame(rows, "set_id long, n long, held array<long>")).collect()
    by_set = {}
    for r in got:
        by_set.setdefault(r.set_id, []).append(r.shared)
    held = {k: set(h) for k, _, h in rows}
    assert all(len(set(v)) == len(v) and 35 <= min(v) and max(v) <= 36 for v in by_set.values())
    meet = {(a.set_id, b.set_id) for a in got for b in got if a.shingle == b.shingle and 7 * min(a.shared, b.shared) >= 3 * (a.n + b.n)}
    linked = [(a, b) for a, b in itertools.combinations(held, 2) if 7 * len(held[a] & held[b]) >= 240]
    assert linked and all(p in meet for p in linked)
