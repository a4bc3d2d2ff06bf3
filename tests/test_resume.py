"""Rejected rows beside the good ones, and jobs that go on as streams."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from sluiceway.plans.runner import rejects_table, run
from sluiceway.session import scratch_dir
from sluiceway.sinks import ledger, storage


def lines(spark, base, name, *rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(f"{base}/{name}")


def spec(base, name, disposition=None, rules=None, incremental=None, **options):
    return {"identity": "p", "source_uri": f"file://{base.removeprefix('file:')}", "destination_uri": "file:///out", "salt": "s", "resources": [{
        "source_table_name": name, "destination_table_name": "t", "write_disposition_config": disposition or {"type": "append"},
        "column_rules": rules or {}, "incremental_config": incremental, "source_options": options}]}


def kept(dataset):
    return sorted((r.reason, r.value) for r in dataset.read(rejects_table("t")).collect())


def test_inferred_types_and_counts(spark, dataset):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl", '{"id": 1, "v": "x"}', '{"id": 2, "v"', '{"id": 3, "v": null}', "[]", "7")
    got = run(spark, spec(base, "a.jsonl"), dataset=dataset)
    assert got["rows"] == {"t": 2, "_rejects_t": 2}  # an empty array holds no row
    assert sorted((r.id, r.v) for r in dataset.read("t").collect()) == [(1, "x"), (3, None)]
    assert "_corrupt_record" not in dataset.read("t").columns and kept(dataset) == [("malformed", '{"id": 2, "v"'), ("not an object", "7")]
    assert [r.rows_written for r in ledger.loads(dataset).filter("table_name = '_rejects_t'").collect()] == [2]
    assert ledger.run_metrics(dataset).filter("name = 'a.jsonl:rejects'").select("row_count").first()[0] == 2


def test_csv_without_schema(spark, dataset):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.csv", "id,name", '1,"a, b"', "2", "3,c,d", "4,e")
    run(spark, spec(base, "a.csv"), dataset=dataset)
    assert sorted((r.id, r.name) for r in dataset.read("t").collect()) == [(1, "a, b"), (4, "e")]
    assert kept(dataset) == [("another number of fields", "2"), ("another number of fields", "3,c,d")]


def test_rules_hide_the_text(spark, dataset):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl", '{"id": 1, "name": "ann"}', '{"id": "x", "name": "bob"}')
    run(spark, spec(base, "a.jsonl", rules={"pseudonymizing_columns": ["name"]}, schema="id long, name string"), dataset=dataset)
    (row,) = dataset.read(rejects_table("t")).collect()
    assert (row.reason, row.value) == ("a value is not of the declared type", None) and "a.jsonl" in row.file
    assert [r.name == "ann" for r in dataset.read("t").collect()] == [False]


def test_with_cursor_limit_filter_and_transform(spark, dataset):
    """Rejected rows are kept by each load that reads them; they move no cursor and take no place in a limit."""
    base = scratch_dir(spark, "in")
    good = [json.dumps({"id": k, "at": k}) for k in range(1, 7)]
    lines(spark, base, "a.jsonl", '{"id": 9, "at": "late"}', '{"id": 99', *good)
    job = spec(base, "a.jsonl", incremental={"incremental_key": "at"}, schema="id long, at long", limit=4)
    for _ in range(3):
        run(spark, job, dataset=dataset, transform=lambda df: df.select("id", "at", "__cursor", (F.col("id") * 2).alias("twice")))
    assert sorted((r.id, r.twice) for r in dataset.read("t").collect()) == [(k, 2 * k) for k in range(1, 7)]
    assert ledger.stored_cursor(dataset, "p.t") == "6"
    assert {v for _, v in kept(dataset)} == {'{"id": 9, "at": "late"}', '{"id": 99'}
    assert ledger.run_metrics(dataset).filter("name like '%null_cursor' and row_count > 0").count() == 0


@pytest.mark.parametrize("disposition", [
    {"type": "replace"}, {"type": "replace", "strategy": "staging-optimized"}, {"type": "merge", "strategy": "upsert", "config": {"primary_key": "id"}},
    {"type": "merge", "strategy": "scd2", "config": {"natural_merge_key": "id"}}, {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "id"}},
])
def test_every_disposition_publishes_both(spark, dataset, disposition):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl", '{"id": 1, "items": [1, 2]}', '{"id": 2, "items": "no"}', "{", "{")
    run(spark, spec(base, "a.jsonl", disposition, schema="id long, items array<long>"), dataset=dataset)
    assert [r.id for r in dataset.read("t").collect()] == [1]
    assert sorted(r[0] for r in kept(dataset)) == ["a value is not of the declared type", "malformed", "malformed"]
    commits = [storage.read_json(spark, f"{dataset.base}/_commits/{n}") for n in dataset.commits()]
    last = {t["name"] for t in commits[-1]["tables"] if t["changed"]}
    assert {"t", "_rejects_t"} <= last  # one commit has both


def test_only_rejected_rows(spark, dataset):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl", "{", "}")
    run(spark, spec(base, "a.jsonl", schema="id long"), dataset=dataset)
    assert dataset.read("t").count() == 0 and len(kept(dataset)) == 2


def test_resumed_job_loads_every_file_once(spark, dataset):
    base = scratch_dir(spark, "in")
    job = spec(base, "a.jsonl", {"type": "merge", "strategy": "upsert", "config": {"primary_key": "id"}}, resume=True, schema="id long, v string", batch_size=1)
    lines(spark, base, "a.jsonl.1", '{"id": 1, "v": "a"}', '{"id": 2, "v": "a"}')
    assert run(spark, job, dataset=dataset)["rows"] == {"t": 2}
    lines(spark, base, "a.jsonl.2", '{"id": 2, "v": "b"}', "{")
    lines(spark, base, "a.jsonl.3", '{"id": 3, "v": "c"}')
    run(spark, job, dataset=dataset)
    assert run(spark, job, dataset=dataset)["rows"] == {}
    assert sorted((r.id, r.v) for r in dataset.read("t").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert kept(dataset) == [("malformed", "{")] and len(dataset.commits()) == 3


def test_a_batch_that_fails_after_its_commit_is_not_loaded_again(spark, dataset, monkeypatch):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl.1", '{"id": 1}', '{"id": 2}')
    job, commit = spec(base, "a.jsonl", resume=True, schema="id long"), type(dataset).commit

    def then_fail(self, *args, **more):
        commit(self, *args, **more)
        raise RuntimeError("lost after the commit")

    with monkeypatch.context() as m:
        m.setattr(type(dataset), "commit", then_fail)
        with pytest.raises(Exception, match="lost after the commit"):
            run(spark, job, dataset=dataset)
    run(spark, job, dataset=dataset)
    assert sorted(r.id for r in dataset.read("t").collect()) == [1, 2] and len(dataset.commits()) == 1


def test_following_takes_what_arrives_meanwhile(spark, dataset):
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl.1", '{"id": 1}')
    job = spec(base, "a.jsonl", resume=True, schema="id long", follow=25, batch_timeout=1)

    def later():
        time.sleep(8)
        lines(spark, base, "a.jsonl.2", '{"id": 2}')

    thread = threading.Thread(target=later)
    thread.start()
    run(spark, job, dataset=dataset)
    thread.join()
    assert sorted(r.id for r in dataset.read("t").collect()) == [1, 2] and len(dataset.commits()) == 2


@pytest.mark.parametrize("change, message", [
    ({"limit": 3}, "limit"), ({"new_files": True}, "new_files"), ({"disposition": {"type": "replace"}}, "replace"), ({"incremental": {"incremental_key": "id"}}, "incremental_config"),
])
def test_what_a_resumed_job_cannot_have(spark, dataset, change, message):
    with pytest.raises(ValueError, match=message):
        run(spark, spec("/nowhere", "a.jsonl", **{"resume": True, "schema": "id long", **change}), dataset=dataset)


def test_a_source_that_is_no_stream(spark, dataset):
    job = {**spec("/nowhere", "a", resume=True), "source_uri": "postgresql://u:p@h:5432/d"}
    with pytest.raises(ValueError, match="cannot be resumed"):
        run(spark, job, dataset=dataset)


def test_the_middle_time_is_found_by_counts(spark):
    """The place in the sorted times is found without collecting them, also among ties and below zero."""
    from suite.resuming import _at_rank

    values = [5, 5, 5, 9, -4_000_000, -3, -3, 1_700_000_000_123, 1_700_000_000_124]
    rows = spark.createDataFrame([(v,) for v in values], "t long").coalesce(1).cache()
    assert [_at_rank(rows, "t", r) for r in (0, 2, 4, 8)] == [sorted(values)[r] for r in (0, 2, 4, 8)]


def test_one_file_of_messages_is_decoded_by_several_tasks(spark, dataset):
    """A row group is read by one task; the messages are dealt out before they are decoded, in a resumed and in a bounded run."""
    base = scratch_dir(spark, "in")
    rows = spark.range(0, 100_000, 1, 1).selectExpr(
        "'t' as topic", "0 as partition", "id as offset", "id as timestamp", "cast(null as binary) as key", "cast(concat('{\"k\":', id, ',\"x\":\"', sha2(string(id), 256), '\"}') as binary) as value")
    rows.write.parquet(f"{base}/m.parquet.1")
    for options in ({"resume": True}, {"start_from": "timestamp:10"}):
        job = spec(base, "m.parquet", payload="k long, x string", **options)
        seen = set(dataset.table("t").paths) if dataset.table("t") else set()
        run(spark, job, dataset=dataset)
        new = [f for p in dataset.table("t").paths if p not in seen for f in storage.files_in(spark, p)]
        assert len(new) > 1
    assert dataset.read("t").count() == 100_000 + 99_990


def test_repeats_of_nested_rows_beside_rejected_ones(spark, dataset):
    """Repeated keys leave their newest row, a flagged one deletes, and every rejected line stays."""
    base = scratch_dir(spark, "in")
    merge = {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "id", "hard_delete_column": "gone", "dedup_sort_column": {"at": "desc"}}}
    job = spec(base, "a.jsonl", merge, schema="id long, at long, gone boolean, body array<string>")
    lines(spark, base, "a.jsonl", '{"id": 1, "at": 1, "body": ["a", "b"]}', '{"id": 1, "at": 2, "body": ["c"]}', '{"id": 2, "at": 1, "body": ["d"]}', '{"id"', '{"id"', "7")
    run(spark, job, dataset=dataset)
    assert sorted(r.value for r in dataset.read("t__body").collect()) == ["c", "d"] and len(kept(dataset)) == 3
    base = scratch_dir(spark, "in")
    lines(spark, base, "a.jsonl", '{"id": 2, "at": 3, "gone": true, "body": []}', '{"id": 2, "at": 2, "body": ["late"]}', '{"id": 3, "at": 1, "body": ["e"]}')
    run(spark, {**job, "source_uri": f"file://{base.removeprefix('file:')}"}, dataset=dataset)
    assert sorted(r.id for r in dataset.read("t").collect()) == [1, 3]
    assert sorted(r.value for r in dataset.read("t__body").collect()) == ["c", "e"]
