"""The multi-run load scenarios: append, delete-insert, upsert, type 2, children, failures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluiceway.plans.runner import run
from sluiceway.sinks import ledger

PRICES = "name string, symbol string, date date, high double"
ROWS = [("Coin", "C", f"2021-01-0{i}", 10.0 + i) for i in range(1, 7)]


def frame(spark, rows, schema=PRICES):
    return spark.createDataFrame(rows, "name string, symbol string, date string, high double").selectExpr(
        "name", "symbol", "cast(date as date) as date", "high") if schema is PRICES else spark.createDataFrame(rows, schema)


def job(disposition, **more):
    resource = {"source_table_name": "prices.parquet", "destination_table_name": "prices", **more}
    if disposition:
        resource["write_disposition_config"] = disposition
    return {"identity": "prices_job", "source_uri": "file:///in", "destination_uri": "file:///out", "resources": [resource], "salt": "s"}


def load(spark, dataset, spec, df, at=None):
    return run(spark, spec, run_time=at, reader=lambda *_: df, dataset=dataset)


def test_append_repeats_what_is_read_again(spark, dataset):
    spec = job({"type": "append"})
    load(spark, dataset, spec, frame(spark, ROWS[:3]))
    assert dataset.read("prices").count() == 3
    load(spark, dataset, spec, frame(spark, ROWS))
    stored = dataset.read("prices")
    assert stored.count() == 9
    assert stored.select("symbol").distinct().count() == 1
    assert stored.select("_row_id").distinct().count() == 9
    assert stored.select("_load_id").distinct().count() == 2


def test_delete_insert_three_then_four(spark, dataset):
    spec = job({"type": "merge", "strategy": "delete-insert", "config": {"delete_insert_config": {"primary_key": ["symbol", "date"]}}})
    load(spark, dataset, spec, frame(spark, ROWS[:3]))
    load(spark, dataset, spec, frame(spark, ROWS[:3] + ROWS[1:4]))
    assert dataset.read("prices").count() == 4
    assert dataset.read("prices").select("symbol").distinct().count() == 1


def test_upsert_one_then_two(spark, dataset):
    spec = job({"type": "merge", "strategy": "upsert", "config": {"upsert_config": {"primary_key": "symbol"}}})
    load(spark, dataset, spec, frame(spark, [("a", "AAA", "2021-01-01", 10.0)]))
    assert dataset.read("prices").count() == 1
    load(spark, dataset, spec, frame(spark, [("a", "AAA", "2021-01-01", 20.0), ("b", "BBB", "2021-01-02", 30.0)]))
    assert {(r.symbol, r.high) for r in dataset.read("prices").collect()} == {("AAA", 20.0), ("BBB", 30.0)}


def counts(dataset):
    rows = dataset.read("prices")
    return rows.filter("valid_to is null").count(), rows.filter("valid_to is not null").count()


def test_type_two_lifecycle(spark, dataset):
    spec = job({"type": "merge", "strategy": "scd2", "config": {"scd2_config": {"active_record_timestamp": None}}})
    load(spark, dataset, spec, frame(spark, ROWS[:3]), datetime(2024, 1, 1, 0, 0))
    assert counts(dataset) == (3, 0)
    changed = [(*ROWS[0][:3], ROWS[0][3] + 1)] + ROWS[1:3]
    load(spark, dataset, spec, frame(spark, changed), datetime(2024, 1, 2, 0, 0))
    assert counts(dataset) == (3, 1)
    now = dataset.read("prices").filter("valid_to is null and date = date'2021-01-01'").collect()
    assert [r.high for r in now] == [ROWS[0][3] + 1]
    load(spark, dataset, spec, frame(spark, [changed[0], changed[2]]), datetime(2024, 1, 3, 0, 0))
    assert counts(dataset) == (2, 2)
    stored = dataset.read("prices")
    assert stored.select("_row_id").distinct().count() == stored.count()


def test_default_disposition_is_replace(spark, dataset):
    load(spark, dataset, job(None), frame(spark, ROWS))
    load(spark, dataset, job(None), frame(spark, ROWS[:2]))
    assert dataset.read("prices").count() == 2


def test_incremental_slices_equal_one_full_load(spark, dataset):
    spec = job({"type": "append"}, incremental_config={"incremental_key": "date"})
    for upto in (2, 4, 4, 6):
        load(spark, dataset, spec, frame(spark, ROWS[:upto]))
    assert sorted(str(r.date) for r in dataset.read("prices").collect()) == [r[2] for r in ROWS]
    assert ledger.stored_cursor(dataset, "prices_job.prices") == "2021-01-06"


def test_load_without_new_rows_keeps_state_and_null_cursors_are_counted(spark, dataset):
    spec = job({"type": "append"}, incremental_config={"incremental_key": "date"})
    load(spark, dataset, spec, frame(spark, ROWS[:2] + [("Coin", "C", None, 1.0)]))
    load(spark, dataset, spec, frame(spark, ROWS[:2]))
    assert dataset.read("prices").count() == 2
    assert ledger.stored_cursor(dataset, "prices_job.prices") == "2021-01-02"
    nulls = ledger.run_metrics(dataset).filter(F.col("name") == "prices.parquet:null_cursor").agg(F.sum("row_count")).first()[0]
    assert nulls == 1


def test_backfill_keeps_state(spark, dataset):
    load(spark, dataset, job({"type": "append"}, incremental_config={"incremental_key": "date"}), frame(spark, ROWS))
    back = {"incremental_key": "date", "start_position": "2021-01-01", "end_position": "2021-01-03", "boundary_mode": "start-end"}
    load(spark, dataset, job({"type": "append"}, incremental_config=back), frame(spark, ROWS))
    assert dataset.read("prices").count() == 9
    assert ledger.stored_cursor(dataset, "prices_job.prices") == "2021-01-06"


def test_cursor_may_be_excluded_and_key_pseudonymised(spark, dataset):
    rules = {"exclude_columns": ["date"], "pseudonymizing_columns": ["symbol"]}
    spec = job({"type": "merge", "strategy": "upsert", "config": {"primary_key": "symbol"}}, column_rules=rules,
               incremental_config={"incremental_key": "date"})
    load(spark, dataset, spec, frame(spark, [("a", "AAA", "2021-01-01", 1.0)]))
    load(spark, dataset, spec, frame(spark, [("a", "AAA", "2021-01-02", 2.0)]))
    rows = dataset.read("prices").collect()
    assert [r.high for r in rows] == [2.0] and len(rows[0].symbol) == 64 and "date" not in rows[0].asDict()


def nested(spark, ids, tag):
    return spark.range(1).select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("id")).select(
        "id", F.lit(tag).alias("tag"), F.struct(F.lit("x").alias("Inner")).alias("Outer"),
        F.array(F.struct(F.lit(1).alias("n"), F.array(F.lit("p"), F.lit("q")).alias("deep")), F.struct(F.lit(2).alias("n"), F.array(F.lit("r")).alias("deep"))).alias("items"))


@pytest.mark.parametrize("buckets", [1, 4])
def test_children_follow_their_roots(spark, dataset, buckets):
    spec = job({"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "id", "hard_delete_column": "gone"}},
               source_options={"buckets": buckets})
    load(spark, dataset, spec, nested(spark, [1, 2, 3], "old").withColumn("gone", F.lit(False)))
    assert dataset.read("prices").columns[:3] == ["id", "tag", "outer__inner"]
    assert dataset.read("prices__items").count() == 6 and dataset.read("prices__items__deep").count() == 9
    load(spark, dataset, spec, nested(spark, [2, 3, 4], "new").withColumn("gone", F.col("id") == 3))
    roots = {(r.id, r.tag) for r in dataset.read("prices").collect()}
    assert roots == {(1, "old"), (2, "new"), (4, "new")}
    ids = dataset.read("prices").select("_row_id")
    for name, per_root in (("prices__items", 2), ("prices__items__deep", 3)):
        children = dataset.read(name)
        assert children.count() == 3 * per_root
        assert children.join(ids, children["_root_id"] == ids["_row_id"], "left_anti").count() == 0


def test_keyless_nested_rows_keep_duplicates(spark, dataset):
    df = nested(spark, [1, 1, 2], "same")
    load(spark, dataset, job({"type": "append"}), df)
    assert dataset.read("prices").select("_row_id").distinct().count() == 3
    assert dataset.read("prices__items").select("_root_id").distinct().count() == 3


def test_failed_run_changes_nothing_but_is_recorded(spark, dataset):
    spec = job({"type": "merge", "strategy": "upsert", "config": {"primary_key": "symbol"}})
    load(spark, dataset, spec, frame(spark, ROWS[:1]))
    with pytest.raises(Exception, match="more than one row for key"):
        load(spark, dataset, spec, frame(spark, ROWS[:2]))
    assert dataset.read("prices").count() == 1
    errors = ledger.run_metrics(dataset).filter("error is not null").collect()
    assert [e.step for e in errors] == ["load"]


@pytest.mark.parametrize("change, message", [
    ({"identity": ""}, "identity: Field must be provided"),
    ({"source_uri": "ftp://x"}, "Unsupported URI scheme: ftp"),
    ({"resources": []}, "At least one resource"),
    ({"color": "red"}, "unknown keys in job: color"),
])
def test_bad_jobs_are_refused(spark, dataset, change, message):
    with pytest.raises(ValueError, match=message):
        run(spark, {**job({"type": "append"}), **change}, dataset=dataset)


@pytest.fixture
def warehouse(spark, monkeypatch):
    """Stands in for a database: tables as parquet folders."""
    from sluiceway.session import scratch_dir
    from sluiceway.sinks import external

    base = scratch_dir(spark, "warehouse")

    def write(df, uri, dataset, table, mode):
        df.write.mode("overwrite" if mode == "overwrite" else mode).parquet(f"{base}/{dataset}.{table}")

    monkeypatch.setattr(external, "write_external", write)
    monkeypatch.setattr(external, "read_external", lambda spark, uri, dataset, table: spark.read.parquet(f"{base}/{dataset}.{table}"))
    return lambda: spark.read.parquet(f"{base}/public.prices")


@pytest.mark.parametrize("disposition, first, second", [
    ({"type": "append"}, 3, 9), ({"type": "replace"}, 3, 6), ({"type": "replace", "strategy": "insert-from-staging"}, 3, 6),
    ({"type": "merge", "strategy": "upsert", "config": {"primary_key": "date"}}, 3, 6),
    ({"type": "merge", "strategy": "scd2", "config": {"scd2_config": {}}}, 3, 6),
])
def test_other_destinations(spark, dataset, warehouse, disposition, first, second):
    spec = {**job(disposition), "destination_uri": "postgresql://u:p@db:5432/sales", "state_folder": dataset.base}
    run(spark, spec, reader=lambda *_: frame(spark, ROWS[:3]))
    assert warehouse().count() == first
    run(spark, spec, reader=lambda *_: frame(spark, ROWS))
    assert warehouse().count() == second
    with pytest.raises(ValueError, match="state_folder"):
        run(spark, {**spec, "state_folder": None}, reader=lambda *_: frame(spark, ROWS))


def test_cursor_never_moves_back(spark, dataset):
    spec = job({"type": "append"}, incremental_config={"incremental_key": "date", "lag_window": 10, "boundary_mode": "start"},
               source_options={"row_id_keys": ["date"]})
    load(spark, dataset, spec, frame(spark, ROWS))
    load(spark, dataset, spec, frame(spark, ROWS[:2]))
    assert ledger.stored_cursor(dataset, "prices_job.prices") == "2021-01-06"
    assert "__cursor" not in dataset.read("prices").columns


def test_source_filter_and_limit(spark, dataset):
    spec = job({"type": "append"}, incremental_config={"incremental_key": "date"},
               source_options={"filter": {"high": {"$gt": 11.5, "$in": [12.0, 13.0, 14.0]}, "symbol": "C"}, "limit": -2})
    load(spark, dataset, spec, frame(spark, ROWS))
    load(spark, dataset, spec, frame(spark, ROWS))
    assert sorted(r.high for r in dataset.read("prices").collect()) == [12.0, 13.0, 14.0]
    clash = job({"type": "append"}, incremental_config={"incremental_key": "date"}, source_options={"filter": {"date": {"$gte": "2021-01-01"}}})
    with pytest.raises(ValueError, match="already used by the cursor"):
        load(spark, dataset, clash, frame(spark, ROWS))


def test_only_new_files(spark, dataset):
    from sluiceway.session import scratch_dir

    base = scratch_dir(spark, "files")
    spec = {**job({"type": "append"}, source_options={"new_files": True}), "source_uri": f"file://{base.removeprefix('file:')}"}
    for i in range(2):
        frame(spark, ROWS[i:i + 1]).write.parquet(f"{base}/prices.parquet.{i}")
        run(spark, spec, dataset=dataset)
    run(spark, spec, dataset=dataset)
    assert sorted(r.high for r in dataset.read("prices").collect()) == [11.0, 12.0]


def test_row_ids_and_key_types(spark, dataset):
    spec = job({"type": "append"}, source_options={"row_id_keys": ["date"]})
    for _ in range(2):
        load(spark, dataset, spec, frame(spark, ROWS[:2]))
    assert dataset.read("prices").select("_row_id").distinct().count() == 4
    merge = job({"type": "merge", "strategy": "upsert", "config": {"primary_key": "k"}}, destination_table_name="m",
                source_options={"buckets": 4})
    load(spark, dataset, merge, spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"))
    first = {r.k: r._row_id for r in dataset.read("m").collect()}
    load(spark, dataset, merge, spark.createDataFrame([(1, 5)], "k long, v int"))
    rows = dataset.read("m").collect()
    assert {(r.k, r.v) for r in rows} == {(1, 5), (2, 2)} and {r.k: r._row_id for r in rows} == first
    with pytest.raises(ValueError, match="key column k changed"):
        load(spark, dataset, merge, spark.createDataFrame([("1", 5)], "k string, v int"))
