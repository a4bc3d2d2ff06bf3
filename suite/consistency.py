"""What must hold over several runs: limits with state, changed type-2 marks, child tables that follow their root."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.scd2 import Scd2, boundary_time
from sluiceway.plans.runner import run
from sluiceway.session import scratch_dir
from suite.common import ORDERS_COLUMNS, new_dataset, plain, query, sql_ts, table
from suite.merging import _DAY1, _DAYS, _T, _day0, _day1
from suite.rules import file_reader, job


@query("incr_limit_resume", f"SELECT {ORDERS_COLUMNS}, (SELECT {sql_ts('max(o_orderdate)')} FROM orders) AS stored_cursor FROM orders")
def incr_limit_resume(spark, sf_dir):
    """Limited runs, the newest rows asked for first, until nothing is left: every order arrives once, ties too."""
    dataset = new_dataset(spark, "limit-resume")
    a_third = table(spark, sf_dir, "orders").count() // 3 + 1
    spec = job("limited", [{
        "source_table_name": "orders.parquet", "destination_table_name": "orders",
        "incremental_config": {"incremental_key": "o_orderdate"}, "write_disposition_config": {"type": "append"},
        "source_options": {"row_id_keys": ["o_orderkey"], "limit": a_third, "row_order": "desc"},
    }])
    for _ in range(4):
        run(spark, spec, reader=file_reader(sf_dir), dataset=dataset)
    stored = F.lit(dataset.latest()["state"][0]["cursor"]).cast("timestamp_ntz")
    return plain(dataset.read("orders").drop("_row_id", "_load_id").withColumn("stored_cursor", stored))


@query("scan_limit_new_files", "SELECT s_suppkey::INT AS n_key, s_name AS n_name FROM supplier UNION ALL SELECT n_nationkey, n_name FROM nation")
def scan_limit_new_files(spark, sf_dir):
    """A limit takes whole files, so a file that is newer than the cursor is never half read."""
    base = scratch_dir(spark, "limit-files")
    dataset = new_dataset(spark, "limit-new-files")
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("n_key"), F.col("s_name").alias("n_name")).repartition(3).write.parquet(f"{base}/party.parquet.1")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n_key"), "n_name").write.parquet(f"{base}/party.parquet.2")
    spec = job("files", [{
        "source_table_name": "party.parquet", "destination_table_name": "party", "write_disposition_config": {"type": "append"},
        "source_options": {"row_id_keys": ["n_key", "n_name"], "limit": 5, "new_files": True},
    }], source_uri=f"file://{base.removeprefix('file:')}")
    for _ in range(6):
        run(spark, spec, dataset=dataset)
    return dataset.read("party").drop("_row_id", "_load_id")


@query("scd2_marker_changed", f"""
    WITH {_DAY1}
    SELECT {ORDERS_COLUMNS}, '{_T[0]}' AS valid_from, NULL::VARCHAR AS valid_to FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, '{_T[0]}', '{_T[1]}' FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, '{_T[1]}', NULL::VARCHAR FROM day1
        WHERE o_orderstatus = 'N' OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
""")
def scd2_marker_changed(spark, sf_dir):
    """Between two runs the mark of active versions changes from a far date to NULL; no version is lost or doubled."""
    dataset = new_dataset(spark, "scd2-marker")
    dataset.commit([dataset.merge_scd2("orders", _day0(spark, sf_dir), boundary_time(_DAYS[0]))])
    dataset.commit([dataset.merge_scd2("orders", _day1(spark, sf_dir), boundary_time(_DAYS[1]), Scd2(active_until=None))])
    return plain(dataset.read("orders"))


def _documents(spark, sf_dir):
    """Documents with their lines as a list."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.split("text", "\n").alias("body"))


def _load(spark, dataset, rows, disposition):
    spec = job("nested", [{"source_table_name": "text", "destination_table_name": "text", "write_disposition_config": disposition}])
    run(spark, spec, reader=lambda *_: rows, dataset=dataset)


def _roots_and_lines(dataset):
    """Root rows as line -1, and all stored lines; a line without a root has no id."""
    root, lines = dataset.read("text"), dataset.read("text__body")
    ids = root.select("id", F.col("_row_id").alias("_root"))
    found = lines.join(ids, F.col("_root_id") == F.col("_root"), "left").select("id", F.col("_list_idx").cast("long").alias("list_idx"), F.col("value").alias("line"))
    return root.select("id", F.lit(-1).cast("long").alias("list_idx"), F.col("title").alias("line")).unionByName(found)


_LINES = """docs AS (SELECT doc_id AS id, lang AS title, string_split(text, chr(10)) AS l FROM documents),
    lines AS (SELECT id, unnest(range(len(l)))::BIGINT AS list_idx, unnest(l) AS line FROM docs)"""
_MERGE = {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "id", "hard_delete_column": "gone"}}


@query("merge_child_hard_delete", f"""
    WITH {_LINES}, kept AS (SELECT * FROM docs WHERE id NOT IN (SELECT page_id FROM pages))
    SELECT id, -1::BIGINT AS list_idx, title AS line FROM kept UNION ALL SELECT * FROM lines WHERE id IN (SELECT id FROM kept)
""")
def merge_child_hard_delete(spark, sf_dir):
    """A change feed of keys and flags removes documents and, with them, their lines."""
    dataset = new_dataset(spark, "child-delete")
    _load(spark, dataset, _documents(spark, sf_dir).withColumn("gone", F.lit(False)), _MERGE)
    feed = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit(True).alias("gone"))
    _load(spark, dataset, feed, _MERGE)
    return _roots_and_lines(dataset)


@query("merge_child_absent_column", f"""
    WITH {_LINES}, p AS (SELECT page_id AS id, url AS title FROM pages)
    SELECT id, -1::BIGINT AS list_idx, title AS line FROM docs WHERE id NOT IN (SELECT id FROM p)
    UNION ALL SELECT id, -1, title FROM p
    UNION ALL SELECT * FROM lines WHERE id NOT IN (SELECT id FROM p)
""")
def merge_child_absent_column(spark, sf_dir):
    """A delete-insert without the list replaces whole rows: the old lists go."""
    dataset = new_dataset(spark, "child-absent")
    disposition = {**_MERGE, "config": {"primary_key": "id"}}
    _load(spark, dataset, _documents(spark, sf_dir), disposition)
    _load(spark, dataset, table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("title")), disposition)
    return _roots_and_lines(dataset)


@query("write_replace_nested", "SELECT page_id AS id, -1::BIGINT AS list_idx, url AS line FROM pages")
def write_replace_nested(spark, sf_dir):
    """A replace without the list leaves no line of the rows that are gone."""
    dataset = new_dataset(spark, "replace-nested")
    disposition = {"type": "replace", "strategy": "insert-from-staging"}
    _load(spark, dataset, _documents(spark, sf_dir), disposition)
    _load(spark, dataset, table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("title")), disposition)
    return _roots_and_lines(dataset)
