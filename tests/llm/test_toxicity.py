import random
import zlib

import numpy as np
import pytest

from sluiceway.llm import queries, toxicity
from sluiceway.llm.toxicity import maximal_segments, tokens_of


def naive_segments(scores):
    """Maximal scoring segments by their recursive definition: the best one, then left and right of it."""
    def split(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and j - i < best[1] - best[0])):
                    best = (i, j, total)
        if best is None:
            return []
        return split(lo, best[0]) + [best] + split(best[1] + 1, hi)

    return split(0, len(scores))


@pytest.mark.parametrize("seed", range(25))
def test_linear_scan_equals_definition(seed):
    rng = random.Random(seed)
    gains = {p: rng.uniform(0.1, 3) for p in sorted(rng.sample(range(60), 14))}
    line = [gains.get(p, -0.4) for p in range(60)]
    places = sorted(gains)
    found = [(places[a], places[b], round(total, 9)) for a, b, total in maximal_segments(places, [gains[p] for p in places], 0.4)]
    assert found == [(a, b, round(total, 9)) for a, b, total in naive_segments(line)]


def test_decay_solves_its_equation():
    scores, counts = np.array([1.0, 2.5]), np.array([10.0, 3.0])
    x = toxicity.solve_decay(scores, counts, 1000.0)
    assert abs((counts * np.exp(x * scores)).sum() / 1013 + 1000 / 1013 * np.exp(-x * toxicity.TOKEN_COST) - 1) < 1e-6


def test_tokens():
    assert tokens_of("You IDIOT, l'été!") == [b"you", b"idiot", "l'été".encode()] and tokens_of(None) == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op4_toxicity"](spark, sf).collect()]
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits, wrong = sum(p and y for p, y in seen), sum(p and not y for p, y in seen)
    assert hits >= 0.8 * sum(y for _, y in seen) and wrong <= 0.05 * len(seen)


def test_odd_rows(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (9, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(odd, labels).count() == len(odd_rows) and toxicity.score(empty, labels).count() == 0


def test_other_labels_are_no_labels(spark):
    words = spark.range(400).selectExpr("id as doc_id", "if(id % 4 = 0, 'you idiot moron', 'a kind word here') as text")
    right = words.selectExpr("doc_id", "if(doc_id % 4 = 0, 1, 0) as toxic")
    other = right.unionByName(spark.range(400).selectExpr("id as doc_id", "if(id % 2 = 0, 2, -1) as toxic"))
    want, got = ({r.doc_id: (r.score, r.predicted) for r in toxicity.score(words, x).collect()} for x in (right, other))
    assert got == want and {p for _, p in got.values()} == {0, 1}
    assert {r.score for r in toxicity.score(words, words.selectExpr("doc_id", "2 as toxic")).collect()} == {0.0}
