import random
from collections import Counter

import pytest

from sluiceway.llm import decontaminate, queries
from sluiceway.llm.decontaminate import ItemIndex, question_and_answer
from sluiceway.llm.toxicity import tokens_of


def make_index(items):
    frequency = Counter(t for _, x in items for t in set(tokens_of(x)))
    lengths = [len(tokens_of(x)) for _, x in items if tokens_of(x)]
    return ItemIndex(items, frequency, len(lengths), sum(lengths) / max(len(lengths), 1))


@pytest.mark.parametrize("block", [1, 2, 32])
def test_wand_equals_scoring_everything(block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_POSTINGS", block)
    rng = random.Random(block)
    vocabulary = [f"t{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, weights=range(60, 0, -1), k=rng.randint(1, 15)))) for k in range(80)]
    index = make_index(items)
    for _ in range(200):
        terms = sorted({index.terms[t.encode()] for t in rng.sample(vocabulary, rng.randint(1, 25)) if t.encode() in index.terms})
        scores: dict[int, float] = {}
        for t in terms:
            for item, weight in zip(index.lists[t], index.weights[t], strict=True):
                scores[item] = scores.get(item, 0) + weight
        want = {i: s for i, s in scores.items() if s >= decontaminate.THRESHOLD + 1e-9}
        got = dict(index.search(terms))
        assert set(want) <= set(got) and all(abs(scores[i] - s) < 1e-9 for i, s in got.items())


def test_parts():
    assert question_and_answer("What is two and two? Four.") == ("What is two and two", " Four.")
    assert question_and_answer("Q: x\nAnswer: y") == ("Q: x\n", " y")
    assert question_and_answer("One. Two three. Four.") == ("One. Two three.", "Four.") and question_and_answer("only") == ("only", "")


def test_leaks_anywhere_in_long_texts():
    rng = random.Random(4)
    items = [(k, " ".join(f"q{k}x{i}" for i in range(rng.randint(4, 30))) + ". " + f"answer{k} is here.") for k in range(50)]
    index = make_index(items)
    filler = [f"f{k}" for k in range(500)]
    for place in (0, 17, 900, 2000):
        words = rng.choices(filler, k=2000)
        text = " ".join([*words[:place], items[7][1].upper(), *words[place:]])
        assert [index.keys[n] for n, *_ in index.leaks(text)] == [7]
    assert index.leaks(" ".join(rng.choices(filler, k=3000))) == [] and index.leaks(None) == [] and index.leaks("") == []
    question_only = items[7][1].split(". ")[0]
    assert index.leaks(question_only + " and quite another ending") == []


def test_query_finds_contained_items(spark):
    sf = "/root/testdata/sf0.01"
    fold = lambda x: b" ".join(tokens_of(x))
    items = [(r.item_id, fold(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, fold(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(d, i) for d, text in docs for i, item in items if item in text}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op10_decontamination"](spark, sf).collect()}
    assert want and got == want


def test_many_parts_and_odd_rows(spark, odd, odd_rows, empty):
    clean = odd_rows[0][1]
    items = spark.createDataFrame([(1, clean[:200]), (2, None), (3, ""), (None, "totally other words. here."), (1, clean[:200])], "item_id long, text string")
    one = sorted(map(str, decontaminate.find_leaks(odd, items).collect()))
    two = decontaminate.find_leaks(odd, items)
    assert one == sorted(map(str, two.collect())) and {r.doc_id for r in two.collect()} == {1, 2, None, 9}
    parts = list(decontaminate.build_indexes(items, index_bytes=100))
    assert sum(len(p.keys) for p in parts) == 3 and len(list(decontaminate.build_indexes(items))) == 1
    kept = decontaminate.keep_clean(odd, items)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 7, 8, None}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(odd, nothing).count() == 0 and decontaminate.keep_clean(odd, nothing).count() == len(odd_rows)
    assert decontaminate.find_leaks(empty, items).count() == 0


def test_a_long_item_does_not_widen_the_search_for_others():
    """Words of a short item scattered over a text are no leak, and a copy is one, whatever other items there are."""
    short = (1, "alpha beta gamma delta epsilon zeta eta? omega")
    others = [(2, " ".join(f"long{k}" for k in range(5000)) + ". the end of it."), (3, "some other item? yes")]
    filler = [f"f{k % 700}" for k in range(4000)]
    scattered = " ".join([*filler[:300], "alpha beta gamma delta", *filler[300:1500], "delta epsilon zeta eta", *filler[1500:3000], "omega", *filler[3000:]])
    copies = [" ".join([*filler[:k], short[1], *filler[k:]]) for k in (0, 5, 2501, 3999)]
    for items in ([short, others[1]], [short, *others]):
        index = make_index(items)
        assert index.leaks(scattered) == []
        assert all([index.keys[n] for n, *_ in index.leaks(x)] == [1] for x in copies)


def test_windows_of_any_length_lie_in_the_passages():
    """Copies of items of every length are found at every place, also across ends of passages and blocks."""
    rng = random.Random(6)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n)) + ". " + f"end{n} word{n}") for n in (3, 7, 20, 41, 60)]
    index = make_index(items)
    for key, text in items:
        for place in rng.sample(range(900), 60):
            words = [f"f{k}" for k in range(1000)]
            assert [index.keys[n] for n, *_ in index.leaks(" ".join([*words[:place], text, *words[place:]]))] == [key]


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "double", "decimal(12,2)", "date", "timestamp", "binary"])
def test_items_with_ids_of_any_type(spark, kind):
    of = {"date": "date_add(date'2020-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id)", "binary": "cast(cast(id as string) as binary)"}.get(kind, f"cast(id as {kind})")
    text = "concat('What colour is the bird number', id, ' of the old garden? It is blue', id, '.')"
    items = spark.range(3).selectExpr(f"if(id = 2, null, {of}) as item_id", f"{text} as text")
    docs = spark.range(4).selectExpr("id as doc_id", f"{text} as text")
    got = decontaminate.find_leaks(docs, items)
    assert got.schema["item_id"].dataType == items.schema["item_id"].dataType
    want = {(r.id, r.item) for r in spark.range(3).selectExpr("id", f"if(id = 2, null, {of}) as item").collect()}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
