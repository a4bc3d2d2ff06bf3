"""What the plans look like: pushed filters, pruned columns, skew handling, no Python in the rows' way."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import merge as merges
from sluiceway.operators import normalize
from sluiceway.operators.dedup import dedup
from sluiceway.operators.incremental import Cursor, new_rows
from sluiceway.operators.scd2 import Scd2, boundary_time, scd2
from sluiceway.plans.runner import run
from sluiceway.sinks import storage
from sluiceway.sources import files
from suite.catalog import QUERIES
from suite.common import table


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    """The plan after adaptive execution has run it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


PURE = [q for q in QUERIES if q.startswith(("rule", "incr_cursor", "incr_lag", "dedup", "merge", "scd2_snap", "scd2_nat", "scd2_part",
                                            "decode", "norm", "metrics", "manifest", "uri"))]


@pytest.mark.parametrize("name", PURE)
def test_no_python_in_the_plan(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("EvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_cursor_reaches_the_scan(spark, sf):
    text = plan(new_rows(table(spark, sf, "events"), Cursor("ts", lag=60), last="2024-01-10 00:00:00"))
    assert "GreaterThan(ts,2024-01-09T23:59)" in text
    text = plan(new_rows(table(spark, sf, "orders"), Cursor("o_orderdate", start="1996-01-01", end="1997-01-01", boundary="start")))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text and "LessThan(o_orderdate,1997-01-01T00:00)" in text


def test_columns_are_pruned(spark, sf):
    lines = files.read_files(spark, sf, "lineitem.parquet").filter("l_quantity >= 25.0 and l_returnflag = 'R'")
    text = plan(lines.select("l_orderkey", "l_partkey", "l_quantity"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert "GreaterThanOrEqual(l_quantity,25.0)" in text


def test_measured_keys_leave_the_target_unshuffled(spark, sf):
    target, batch = table(spark, sf, "orders"), table(spark, sf, "orders").limit(10)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1MB"):
        text = executed(merges.delete_insert(target, batch, merge_key="o_custkey", measure=True)).split("Initial Plan")[0]
        joined = text[text.index("LeftAnti"):]
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        assert "Exchange" not in joined[: joined.index("Scan parquet")]
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10B"):
        assert "SortMergeJoin" in plan(merges.delete_insert(target, batch, merge_key="o_custkey", measure=True))


def test_dedup_limits_groups_before_the_shuffle(spark, sf):
    text = plan(dedup(table(spark, sf, "lineitem"), ["l_orderkey"], {"l_shipdate": "desc"}))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("WindowGroupLimit") == 2 and "Partial" in physical and physical.count("Exchange hashpartitioning") == 1


def _skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, 300_000, 1, 16).select(key.alias("k"), F.repeat(F.lit("x"), 40).alias("pad"), F.col("id").alias("v"))


def test_hot_target_key_is_split(spark):
    """A third of the target under one key: the anti-join's hot partition is split at run time."""
    small = "50KB"
    incoming = spark.range(0, 200_000, 1, 8).select((F.col("id") * 5).alias("k"), F.lit("new").alias("pad"), F.col("id").alias("v"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=small,
                  spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes=small):
        merged = merges.delete_insert(_skewed(spark), incoming, merge_key="k")
        assert "skew=true" in executed(merged)
        gone = {0} | set(range(0, 1_000_000, 5))
        expected = sum(1 for i in range(300_000) if (0 if i % 3 == 0 else i) not in gone) + 200_000
        assert merged.count() == expected


def test_small_batch_is_broadcast_at_run_time(spark, sf):
    target = table(spark, sf, "lineitem")
    incoming = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10MB"):
        text = executed(merges.delete_insert(target, incoming, merge_key="l_orderkey"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text.split("Initial Plan")[0]


def test_type_two_shuffles_once(spark, sf):
    orders = table(spark, sf, "orders")
    state = scd2(None, orders, boundary_time("2024-01-01"))
    path = f"{__import__('sluiceway.session', fromlist=['x']).scratch_dir(spark, 'plan')}"
    state.write.parquet(path)
    text = plan(scd2(spark.read.parquet(path), orders, boundary_time("2024-01-02"), Scd2()))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical


def test_identical_rows_are_numbered_in_slices(spark, monkeypatch):
    """A group larger than a slice is written out by several tasks, with every row and distinct ids."""
    monkeypatch.setattr(normalize, "_CHUNK", 1000)
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") < 10_500, -1).otherwise(F.col("id")).alias("k"))
    ids = normalize.with_row_id(rows, "load")
    assert ids.count() == 30_000 and ids.select("_row_id").distinct().count() == 30_000
    assert ids.filter("k = -1").count() == 10_500
    assert "REPARTITION_BY_COL" in plan(ids)


def test_bucketed_merge_touches_only_its_buckets(spark, dataset):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))

    def fn(old, new):
        return merges.upsert(old, new, "k")

    dataset.commit([dataset.merge("t", rows, fn, ["k"], 16)])
    before = set(dataset.table("t").paths)
    change = dataset.merge("t", rows.filter("k = 7").withColumn("v", F.lit(1)), fn, ["k"], 16)
    dataset.commit([change])
    after = set(dataset.table("t").paths)
    assert len(before) == 16 and len(after) == 16 and len(before - after) == 1
    assert change.rows_written < 150
    assert dataset.read("t").agg(F.count("k"), F.sum("v")).first()[:] == (1000, 1)


@pytest.mark.parametrize("keys", [["k"], ["k", "g"]])
def test_merge_rewrites_only_files_that_hold_a_key(spark, dataset, keys):
    """Ten spread keys in a table of forty files, without buckets; rows come out as from a full rewrite."""
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.lit(0).alias("v")).repartitionByRange(40, "k")

    def fn(old, new):
        return merges.delete_insert(old, new, keys)

    dataset.commit([dataset.append("t", rows)])
    stored = dataset.difference(dataset.table("t").paths, ["none"])
    before = {f for p in stored for f in storage.files_in(spark, p)}
    arriving = spark.range(10).select((F.col("id") * 400 + 5).alias("k"), ((F.col("id") * 400 + 5) % 3).alias("g"), F.lit(1).alias("v"))
    dataset.commit([dataset.merge("t", arriving, fn, match=[keys])])
    after = set(dataset.table("t").paths)
    assert len(before) == 40 and len(before & after) == 30
    assert dataset.read("t").agg(F.count("k"), F.countDistinct("k"), F.sum("v")).first()[:] == (4000, 4000, 10)
    new_key = arriving.limit(1).withColumn("k", F.lit(99_999).cast("long"))
    dataset.commit([dataset.merge("t", new_key, fn, match=[keys])])
    assert after < set(dataset.table("t").paths) and dataset.read("t").count() == 4001
    dataset.expire()
    assert dataset.read("t").count() == 4001
    assert {f for p in stored for f in storage.files_in(spark, p)} == before & after  # files that no commit names are gone


def test_both_keys_rewrite_only_files_that_hold_one(spark, dataset):
    """Rows match by primary key or by merge key; files with neither keep their names."""
    rows = spark.range(2000).select(F.col("id").alias("k"), F.expr("id div 10").alias("g"), F.lit("a").alias("v"))
    dataset.commit([dataset.append("t", rows.repartitionByRange(20, "k"))])
    before = {f for p in dataset.table("t").paths for f in storage.files_in(spark, p)}
    arriving = rows.filter("k in (5, 1999)").withColumns({"v": F.lit("b"), "g": F.when(F.col("k") == 5, F.lit(77)).otherwise(F.col("g"))})
    dataset.commit([dataset.merge("t", arriving, lambda old, new: merges.delete_insert(old, new, "k", "g"), match=[["k"], ["g"]])])
    assert len(before) == 20 and len(before & set(dataset.table("t").paths)) == 17
    gone = {k for k in range(2000) if k // 10 in (77, 199)}
    assert {r.k: r.v for r in dataset.read("t").collect()} == {k: "b" if k in (5, 1999) else "a" for k in range(2000) if k not in gone or k in (5, 1999)}


def test_children_follow_when_parts_of_folders_stay(spark, dataset):
    """Roots and their lists after three loads by both keys, each of which leaves files of the one before."""
    rows = spark.range(300).select(F.col("id").alias("k"), F.expr("id div 10").alias("g"), F.lit("a").alias("v"), F.array("id", F.col("id") + 1).alias("items"))
    spec = {"identity": "p", "source_uri": "file:///in", "destination_uri": "file:///out", "resources": [{
        "source_table_name": "t.parquet", "destination_table_name": "t",
        "write_disposition_config": {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "k", "merge_key": "g"}}}]}
    want = {}
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        for v, part in (("a", "true"), ("b", "k in (5, 299)"), ("c", "k = 6 or k = 120")):
            batch = rows.filter(part).withColumn("v", F.lit(v))
            run(spark, spec, reader=lambda *_, df=batch: df, dataset=dataset)
            arrived = {r.k: r.g for r in batch.select("k", "g").collect()}
            want = {k: x for k, x in want.items() if k not in arrived and x[0] not in arrived.values()} | {k: (g, v) for k, g in arrived.items()}
    assert {r.k: (r.g, r.v) for r in dataset.read("t").collect()} == want
    lists = dataset.read("t__items").join(dataset.read("t").select(F.col("_row_id").alias("_root_id"), "k"), "_root_id")
    assert sorted((r.k, r.value) for r in lists.collect()) == sorted((k, k + d) for k in want for d in (0, 1))
    assert dataset.read("t__items").count() == 2 * len(want)


def test_history_is_not_rewritten(spark, dataset):
    def day(rows, at):
        df = spark.createDataFrame(rows, "k int, v string")
        dataset.commit([dataset.merge_scd2("d", df, boundary_time(at), Scd2(natural_key=["k"]), buckets=4)])
        return set(dataset.table("d").paths)

    day([(i, "a") for i in range(50)], "2024-01-01")
    second = day([(1, "b")], "2024-01-02")
    third = day([(2, "b")], "2024-01-03")
    history = {p for p in second if "__bucket=-1" in p}
    assert len(history) == 1 and history <= third
    stored = dataset.read("d")
    assert stored.filter("valid_to = timestamp_ntz'9999-12-31'").count() == 50 and stored.count() == 52


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(PURE)))
def test_no_cross_join_anywhere(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert node not in text


def test_ids_of_rows_are_counted_without_a_table_of_them(spark, sf):
    """The ids are counted in order as they pass; an aggregate over them would hold every id of a partition in memory, or spill."""
    counted = QUERIES["norm_row_id"](spark, sf)
    assert not [line for line in plan(counted).splitlines() if "Aggregate" in line and ("distinct" in line or "_row_id" in line)]
    assert counted.schema.simpleString() == "struct<l_orderkey:bigint,l_linenumber:int,row_ids:bigint>"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert counted.agg(F.sum("row_ids")).first()[0] == 2 * lines.count()


def test_nested_rows_with_unique_keys_are_not_shuffled(spark, dataset):
    """Before lists are split off, keys alone are counted: whole rows move only where a key repeats."""
    spec = {"identity": "p", "source_uri": "file:///in", "destination_uri": "file:///out", "salt": "s", "resources": [{
        "source_table_name": "t", "destination_table_name": "t",
        "write_disposition_config": {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "id", "dedup_sort_column": {"at": "desc"}}}}]}
    staged, stage = [], dataset.stage

    def noted(name, df, *args, **more):
        if name.startswith("_packages/"):
            staged.append(plan(df))
        return stage(name, df, *args, **more)

    dataset.stage = noted
    unique = spark.range(0, 50, 1, 2).selectExpr("(id * 7) % 50 as id").selectExpr("id", "id as at", "array(id, id + 1) as body")
    run(spark, spec, reader=lambda *_: unique, dataset=dataset)
    assert len(staged) == 1 and "Exchange" not in staged[0]
    repeats = unique.union(spark.sql("select 7L, 100L, array(-1L)")).union(spark.sql("select null, 1L, array(-2L) union all select null, 2L, array(-3L)"))
    run(spark, spec, reader=lambda *_: repeats, dataset=dataset)
    assert sorted((r.id is None, r.id or 0, r.at) for r in dataset.read("t").collect()) == sorted([(False, k, 100 if k == 7 else k) for k in range(50)] + [(True, 0, 2)])
    assert sorted(r.value for r in dataset.read("t__body").filter("value < 0").collect()) == [-3, -1]
    assert dataset.read("t__body").count() == 49 * 2 + 2
