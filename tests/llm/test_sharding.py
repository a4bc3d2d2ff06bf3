import zlib

import pytest

from sluiceway.llm import queries, sharding


def check(rows, n, shards):
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert len(rows) == n and sum(counts) == n and max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_sharding"](spark, sf).collect()
    check(rows, len(texts), 8)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_same_result_however_partitioned_and_really_shuffled(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "concat('t', id) as text")
    a = sorted(map(tuple, sharding.shard_digests(df, bucket_rows=300).collect()))
    b = sorted(map(tuple, sharding.shard_digests(df.repartition(7), bucket_rows=300).collect()))
    c = sorted(map(tuple, sharding.shard_digests(df, bucket_rows=300, seed=5).collect()))
    assert a == b and a != c
    order = [x[0] for x in sorted(a, key=lambda x: (x[4], x[5]))]
    rising = sum(p < q for p, q in zip(order, order[1:], strict=False))
    assert 0.45 < rising / 5000 < 0.55


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9])
def test_few_rows(spark, n):
    check(sharding.shard_digests(spark.range(n).selectExpr("id as doc_id", "cast(null as string) as text")).collect(), n, 8)


def test_one_row_repeated(spark):
    """Equal records are scattered like others."""
    df = spark.range(9000).selectExpr("if(id < 6000, 1, id) as doc_id", "'same' as text")
    check(sharding.shard_digests(df, bucket_rows=500).collect(), 9000, 8)


def test_odd_rows_and_files(spark, odd, odd_rows, tmp_path):
    check(sharding.shard_digests(odd).collect(), len(odd_rows), 8)
    placed = sharding.place(odd, n_shards=3).collect()
    assert sorted(str(tuple(r.record)) for r in placed) == sorted(str(tuple(r)) for r in odd.collect())
    sharding.write_shards(odd.drop("shard"), str(tmp_path / "out"), n_shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(odd_rows)


def test_digests_come_from_placed_whole_records(spark):
    """The digest is read off the records that place() moved, text and all other columns included."""
    df = spark.range(40).selectExpr("id as doc_id", "repeat('x', 1000) as text", "'s' as source")
    plan = sharding.shard_digests(df)._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "Aggregate [record" in line]
    assert counted and "crc32" not in "".join(plan.splitlines()[1:])
    assert set(sharding.place(df).schema["record"].dataType.names) == {"doc_id", "text", "source"}


def test_long_texts_make_more_buckets(spark):
    df = spark.range(64).selectExpr("id as doc_id", "repeat('x', 100000) as text")
    assert sharding.bucket_count(df, bucket_bytes=1 << 20) == (64, 7)
    check(sharding.shard_digests(df, bucket_bytes=1 << 20).collect(), 64, 8)


def test_many_copies_are_dealt_out_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 100)
    df = spark.range(3000).selectExpr("if(id < 2050, 1, id) as doc_id", "'same' as text")
    a = sharding.shard_digests(df, bucket_rows=300).collect()
    check(a, 3000, 8)
    assert sum(r.doc_id == 1 for r in a) == 2050
    assert sorted(a) == sorted(sharding.shard_digests(df.repartition(5), bucket_rows=300).collect())
