"""Commits, replace strategies, streams and their repeats."""

import pytest
from pyspark.sql import functions as F

from sluiceway.session import scratch_dir
from sluiceway.sinks import ledger, storage
from sluiceway.sinks.replace import REPLACE_STRATEGIES, replace_tables
from sluiceway.streaming import topic_stream


def ints(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def seen(dataset, name="t"):
    return sorted(r[0] for r in dataset.read(name).select("k").collect())


@pytest.mark.parametrize("strategy", REPLACE_STRATEGIES)
def test_replace(spark, dataset, strategy):
    replace_tables(dataset, {"t": ints(spark, 1, 2).withColumn("old", F.lit("x"))}, strategy)
    replace_tables(dataset, {"t": ints(spark, 3).withColumn("new", F.lit("y"))}, strategy)
    assert seen(dataset) == [3]
    assert dataset.read("t").columns == (["k", "new"] if strategy == "staging-optimized" else ["k", "old", "new"])


def test_staged_replace_is_never_half_visible(spark, dataset):
    replace_tables(dataset, {"a": ints(spark, 1), "b": ints(spark, 1)}, "insert-from-staging")
    replace_tables(dataset, {"a": ints(spark, 2), "b": ints(spark, 2)}, "insert-from-staging")
    for name in dataset.commits():
        doc = storage.read_json(spark, f"{dataset.base}/_commits/{name}")
        states = {t: sorted(r[0] for r in dataset.read(t, doc).collect()) for t in ("a", "b")}
        assert states["a"] == states["b"] and states["a"]


def test_truncate_leaves_a_moment_without_rows(spark, dataset):
    replace_tables(dataset, {"t": ints(spark, 1)})
    with pytest.raises(Exception):
        replace_tables(dataset, {"t": ints(spark, 1).withColumn("bad", F.raise_error(F.lit("stop")))})
    assert seen(dataset) == []


def test_unknown_strategy(dataset):
    with pytest.raises(ValueError, match="invalid replace strategy"):
        replace_tables(dataset, {}, "swap")


def test_a_stale_merge_is_refused(spark, dataset):
    dataset.commit([dataset.append("t", ints(spark, 1))])
    first, second = dataset.append("t", ints(spark, 2)), dataset.append("t", ints(spark, 3))
    dataset.commit([first])
    with pytest.raises(RuntimeError, match="changed by another load"):
        dataset.commit([second])
    assert seen(dataset) == [1, 2]


def test_a_commit_name_is_taken_once(spark, dataset):
    storage.write_json_once(spark, f"{dataset.base}/_commits/x.json", {"a": 1})
    with pytest.raises(FileExistsError):
        storage.write_json_once(spark, f"{dataset.base}/_commits/x.json", {"a": 2})
    assert storage.read_json(spark, f"{dataset.base}/_commits/x.json") == {"a": 1}


def test_failed_write_is_not_visible(spark, dataset):
    dataset.commit([dataset.append("t", ints(spark, 1))])
    with pytest.raises(Exception):
        dataset.append("t", ints(spark, 2).withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("stop")).cast("int"))))
    assert seen(dataset) == [1]


def test_widening_append_is_refused_and_merge_widens(spark, dataset):
    dataset.commit([dataset.append("t", ints(spark, 1))])
    wide = spark.createDataFrame([(2.5,)], "k double")
    with pytest.raises(ValueError, match="would widen"):
        dataset.append("t", wide)
    from sluiceway.operators.merge import upsert

    dataset.commit([dataset.merge("t", wide, lambda old, new: upsert(old, new, "k"))])
    assert seen(dataset) == [1.0, 2.5]
    assert ledger.schema_versions(dataset).filter("table_name = 't'").count() == 2


def test_narrow_rows_append_into_wide_columns(spark, dataset):
    dataset.commit([dataset.append("t", spark.createDataFrame([(5_000_000_000, "a")], "k long, s string"))])
    dataset.commit([dataset.append("t", ints(spark, 1))])
    assert seen(dataset) == [1, 5_000_000_000]


def test_expire_keeps_what_the_last_commits_use(spark, dataset):
    for value in (1, 2, 3):
        replace_tables(dataset, {"t": ints(spark, value)}, "insert-from-staging")
    assert len(dataset.expire(keep=2)) == 1
    assert seen(dataset) == [3]


def _stream(spark, folder):
    return spark.readStream.schema("k int, v int").option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_goes_on_where_it_stopped_and_skips_a_repeated_batch(spark, dataset):
    folder, checkpoint = scratch_dir(spark, "in"), scratch_dir(spark, "cp")
    write = topic_stream.appender("t")
    for k in (1, 2):
        spark.createDataFrame([(k, k)], "k int, v int").coalesce(1).write.mode("append").parquet(folder)
        topic_stream.start(_stream(spark, folder), dataset.base, "s", write, checkpoint).awaitTermination()
    assert seen(dataset) == [1, 2]
    # as after a crash between the dataset's commit and the checkpoint's: batch 1 runs again
    for name in storage.list_names(spark, f"{checkpoint}/commits"):
        if name.startswith(("1", ".1")):
            storage.remove(spark, f"{checkpoint}/commits/{name}")
    topic_stream.start(_stream(spark, folder), dataset.base, "s", write, checkpoint).awaitTermination()
    assert seen(dataset) == [1, 2]
    # a new checkpoint is a new stream
    topic_stream.start(_stream(spark, folder), dataset.base, "s", write, scratch_dir(spark, "cp")).awaitTermination()
    assert seen(dataset) == [1, 1, 2, 2]


def test_stream_equals_batch(spark, dataset):
    folder = scratch_dir(spark, "in")
    rows = spark.range(200).select((F.col("id") % 17).cast("int").alias("k"), F.col("id").cast("int").alias("v"))
    rows.repartition(5).write.parquet(folder)
    write = topic_stream.upserter("t", ["k"], {"v": "desc"}, buckets=4)
    topic_stream.start(_stream(spark, folder), dataset.base, "u", write, scratch_dir(spark, "cp")).awaitTermination()
    expected = {r.k: r.v for r in rows.groupBy("k").agg(F.max("v").alias("v")).collect()}
    assert {r.k: r.v for r in dataset.read("t").collect()} == expected


def test_type_two_stream(spark, dataset):
    from sluiceway.operators.scd2 import Scd2

    folder, checkpoint = scratch_dir(spark, "in"), scratch_dir(spark, "cp")
    write = topic_stream.historian("t", lambda batch: f"2024-01-0{batch + 1}", Scd2(natural_key=["k"]))
    for v in (1, 2):
        spark.createDataFrame([(1, v)], "k int, v int").coalesce(1).write.mode("append").parquet(folder)
        topic_stream.start(_stream(spark, folder), dataset.base, "h", write, checkpoint).awaitTermination()
    assert dataset.read("t").count() == 2 and dataset.read("t").filter("valid_to = timestamp_ntz'2024-01-02'").count() == 1


def test_compact_keeps_rows_and_history_apart(spark, dataset):
    from sluiceway.operators.scd2 import Scd2, boundary_time

    for i, values in enumerate([(1, 2, 3), (1, 2), (1,)]):
        dataset.commit([dataset.merge_scd2("t", ints(spark, *values), boundary_time(f"2024-01-0{i + 1}"), Scd2())])
    before = sorted(map(tuple, dataset.read("t").collect()))
    dataset.commit([dataset.compact("t")])
    assert sorted(map(tuple, dataset.read("t").collect())) == before
    assert sorted(p.rsplit("=", 1)[1] for p in dataset.table("t").paths) == ["-1", "0"]
    dataset.commit([dataset.merge_scd2("t", ints(spark, 1, 9), boundary_time("2024-01-05"), Scd2())])
    assert dataset.read("t").count() == 4


def test_concurrent_loads_of_different_tables_both_commit(spark, dataset, monkeypatch):
    dataset.commit([dataset.append("a", ints(spark, 1))])
    b, c = dataset.append("b", ints(spark, 2)), dataset.append("c", ints(spark, 3))
    stale, once = dataset.latest(), []

    def latest():
        if not once:
            once.append(1)
            dataset_now.commit([c])  # the other load commits in between
            return stale
        return type(dataset).latest(dataset)

    dataset_now = type(dataset)(spark, dataset.base)
    monkeypatch.setattr(dataset, "latest", latest)
    dataset.commit([b])
    assert [seen(dataset_now, t) for t in ("a", "b", "c")] == [[1], [2], [3]]


@pytest.mark.parametrize("buckets", [1, 4])
def test_type_two_history_follows_a_widened_column(spark, dataset, buckets):
    from sluiceway.operators.scd2 import Scd2, boundary_time

    def day(rows, schema, at):
        df = spark.createDataFrame(rows, schema)
        dataset.commit([dataset.merge_scd2("t", df, boundary_time(at), Scd2(natural_key=["k"]), buckets)])

    day([(1, 1), (2, 2)], "k int, v int", "2024-01-01")
    day([(1, 5)], "k int, v int", "2024-01-02")
    day([(2, 2.5)], "k int, v double", "2024-01-03")
    rows = sorted((r.k, r.v, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in dataset.read("t").collect())
    assert rows == [(1, 1.0, "2024-01-01", "2024-01-02"), (1, 5.0, "2024-01-02", "9999-12-31"),
                    (2, 2.0, "2024-01-01", "2024-01-03"), (2, 2.5, "2024-01-03", "9999-12-31")]


def test_bucketed_merge_widens_every_file(spark, dataset):
    from sluiceway.operators.merge import upsert

    def fn(old, new):
        return upsert(old, new, "k")

    dataset.commit([dataset.merge("t", spark.createDataFrame([(i, i) for i in range(20)], "k int, v int"), fn, ["k"], 8)])
    dataset.commit([dataset.merge("t", spark.createDataFrame([(3, "x")], "k int, v string"), fn, ["k"], 8)])
    assert {r.k: r.v for r in dataset.read("t").collect()} == {i: ("x" if i == 3 else str(i)) for i in range(20)}
