import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from sluiceway.llm import decontaminate, queries, rules_cascade
from sluiceway.llm.secrets import mask
from test_jaccard import brute


def plain_pipeline(docs, items):
    """The stages one after the other, without Spark."""
    docs = {d: t for d, t in docs if rules_cascade.first_reject(rules_cascade.Measures(t), list(rules_cascade.RULES)) is None}
    first = {d for d, (_, c) in brute(docs.items()).items() if d == c}
    fold = lambda t: b" ".join(decontaminate.tokens_of(t))
    folded = [fold(t) for t in items]
    docs = {d: t for d, t in docs.items() if d in first and not any(i in fold(t) for i in folded)}
    return {d: mask(t) for d, t in docs.items()}


def test_run_equals_plain_code(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain_pipeline(docs, items)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    library = Tokenizer.from_file(queries.VOCABULARY)
    assert 0 < len(want) < len(docs) and set(rows) == set(want)
    for d, text in want.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[d].ids == " ".join(map(str, ids)) and rows[d].n_tokens == len(ids)
        assert rows[d].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_on_odd_rows(spark, odd, odd_rows, empty, sf):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, empty):
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            if docs is empty:
                assert rows == []
            elif name not in ("quality rules", "n-gram Jaccard join"):
                assert len(rows) == len(odd_rows)


def test_stages_are_the_five_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "BPE encoding and decoding"]
