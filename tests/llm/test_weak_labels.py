import random

import numpy as np

from sluiceway.llm import queries, weak_labels
from sluiceway.llm.rules_cascade import Measures
from sluiceway.llm.weak_labels import BAD, GOOD, LABELLERS, NONE, Features, LabelModel, Scorer, train_scorer


def test_em_recovers_accuracies():
    rng = random.Random(2)
    accuracy = [rng.uniform(0.7, 0.95) for _ in LABELLERS]
    counts: dict[int, int] = {}
    for _ in range(20_000):
        good = rng.random() < 0.7
        pattern = 0
        for a in accuracy:
            vote = NONE if rng.random() < 0.4 else (GOOD if good == (rng.random() < a) else BAD)
            pattern = pattern * 3 + vote
        counts[pattern] = counts.get(pattern, 0) + 1
    model = LabelModel(counts, rounds=200)
    assert abs(model.share - 0.7) < 0.05
    assert max(abs(x - y) for x, y in zip(model.accuracies().values(), accuracy, strict=True)) < 0.06


def test_posterior_of_unseen_patterns_and_no_documents():
    model = LabelModel({})
    assert 0 < model.posterior(5) < 1


def test_scorer_equals_its_features():
    texts = ["some plain words here.", "BAD!! BAD!! BAD!!", "", "a%%% b$$$ c###"]
    measures = [Measures(t) for t in texts]
    rows = [Features()(m) for m in measures]
    weights = train_scorer(rows, np.array([1.0, 0.0, 0.0, 0.0]))
    scorer = Scorer(weights)
    for m, row in zip(measures, rows, strict=True):
        total = weights[-1] + sum(weights[s] * v for s, v in row.items())
        assert abs(scorer.score(m) - 1 / (1 + np.exp(-total))) < 1e-9
    assert scorer.score(measures[0]) > 0.8 > 0.3 > scorer.score(measures[1])


def test_query_against_gold_labels(spark):
    """Gold labels are only used here."""
    sf = "/root/testdata/sf0.01"
    gold = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_quality_classifier"](spark, sf).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)
    good = [r.kept for r in rows if gold.get(r.doc_id) == 1 and len(texts[r.doc_id].split()) >= 10]
    bad = [r.kept for r in rows if gold.get(r.doc_id) == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.3


def test_odd_rows(odd, odd_rows, empty):
    got = weak_labels.classify(odd).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert weak_labels.classify(empty).count() == 0


def test_sample_takes_a_repeated_id_once(spark, monkeypatch):
    monkeypatch.setattr(weak_labels, "SAMPLE_DOCS", 5)
    rows = spark.range(10_000).selectExpr("1L as doc_id", "concat('b', id) as text").unionByName(spark.range(2, 50).selectExpr("id as doc_id", "'plain words' as text"))
    assert weak_labels.sample_texts(rows, "doc_id", "text").count() == 5
    monkeypatch.setattr(weak_labels, "SAMPLE_DOCS", 100)
    texts = [r[0] for r in weak_labels.sample_texts(rows, "doc_id", "text").collect()]
    assert len(texts) == 49 and texts.count("b0") == 1
