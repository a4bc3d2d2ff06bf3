"""Newest-wins upserts give the same table in any order of batches."""

import random

import pytest
from pyspark.sql import functions as F

from sluiceway.streaming import topic_stream

COLUMNS = ("a", "b")


def expected(events):
    """What the table holds when events (key, order, deletes, values) are applied in their order."""
    out = {}
    for key, at, gone, values in sorted(events, key=lambda e: e[1]):
        if gone:
            out.pop(key, None)
        else:
            out[key] = {**out.get(key, dict.fromkeys(COLUMNS)), **values, "at": at}
    return {k: (v["at"], v["a"], v["b"]) for k, v in out.items()}


def frame(spark, batch):
    """A batch whose rows all have the same columns."""
    names = sorted(batch[0][3]) if not batch[0][2] else []
    rows = [(k, at, gone, *(None if gone else values.get(n) for n in names)) for k, at, gone, values in batch]
    return spark.createDataFrame(rows, "k int, at int, gone boolean" + "".join(f", {n} string" for n in names))


def table_after(spark, dataset, batches, buckets):
    write = topic_stream.upserter("t", ["k"], {"at": "desc"}, "gone", buckets)
    for number, batch in enumerate(batches):
        change = write.apply(dataset, frame(spark, batch), number)
        dataset.commit(change if isinstance(change, list) else [change])
    rows = dataset.read("t")
    for name in COLUMNS:
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast("string"))
    return {r.k: (r["at"], r.a, r.b) for r in rows.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_batches(spark, dataset, seed):
    rng = random.Random(seed)
    events = []
    for at in range(1, 25):
        gone = rng.random() < 0.2
        names = rng.choice([("a",), ("b",), ("a", "b")])
        events.append((rng.randint(1, 3), at, gone, {} if gone else {n: rng.choice([None, f"{n}{at}"]) for n in names}))
    batches = {}
    for e in events:
        batches.setdefault((e[2], tuple(sorted(e[3])), rng.randint(0, 1)), []).append(e)
    order = list(batches.values())
    rng.shuffle(order)
    assert table_after(spark, dataset, order, rng.choice([1, 4])) == expected(events)


def test_a_late_row_does_not_bring_a_key_back(spark, dataset):
    row = lambda at, **values: (1, at, False, values)
    batches = [[row(1, a="x", b="y")], [(1, 5, True, {})], [row(3, a="late", b="late")]]
    assert table_after(spark, dataset, batches, 1) == {}
    write = topic_stream.upserter("t", ["k"], {"at": "desc"}, "gone")
    dataset.commit(write.apply(dataset, frame(spark, [row(7, a="new")]), 3))
    assert [(r.k, r["at"], r.a, r.b) for r in dataset.read("t").collect()] == [(1, 7, "new", None)]  # b was deleted with the key
    dataset.commit(write.apply(dataset, frame(spark, [row(6, b="between")]), 4))
    assert [(r["at"], r.a, r.b) for r in dataset.read("t").collect()] == [(7, "new", "between")]


def test_a_column_that_comes_later(spark, dataset):
    """Rows stored before a column existed take it from older rows that come late, not from newer absence."""
    batches = [[(1, 10, False, {"a": "x"}), (2, 10, False, {"a": "x"})], [(2, 20, False, {"a": "y", "b": "z"})], [(1, 5, False, {"a": "old", "b": "old"})]]
    assert table_after(spark, dataset, batches, 4) == {1: (10, "x", "old"), 2: (20, "y", "z")}


def test_equal_order_and_needed_columns(spark, dataset):
    batches = [[(1, 5, False, {"a": "x"}), (2, 5, False, {"a": "x"})], [(1, 5, True, {})]]
    assert table_after(spark, dataset, batches, 1) == {2: (5, "x", None)}
    with pytest.raises(ValueError, match="need the columns at"):
        topic_stream.upserter("t", ["k"], {"at": "desc"}, "gone").apply(dataset, spark.createDataFrame([(1, True)], "k int, gone boolean"), 0)


def test_full_rows_without_deletes_need_no_memory(spark, dataset):
    write = topic_stream.upserter("t", ["k"], {"at": "desc"})
    for number, at in enumerate((5, 3, 9)):
        change = write.apply(dataset, spark.createDataFrame([(1, at)], "k int, at int"), number)
        dataset.commit(change if isinstance(change, list) else [change])
    assert [r[:] for r in dataset.read("t").collect()] == [(1, 9)] and dataset.table(topic_stream.memory_of("t")) is None
