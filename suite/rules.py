"""Column rules, incremental loading and the flagship load."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.incremental import Cursor, new_rows, ordered
from sluiceway.operators.rules import apply_rules, exclude, pseudonymize
from sluiceway.plans.runner import run
from sluiceway.sinks import ledger
from sluiceway.sources import files
from suite.common import EVENT_COLUMNS, ORDERS_COLUMNS, SALT, new_dataset, plain, query, sql_ts, table


def file_reader(sf_dir):
    """Read job resources from the given tables' folder."""
    return lambda spark, uri, name, options: files.read_files(spark, sf_dir, name)


def job(identity, resources, **more):
    return {"identity": identity, "source_uri": "file:///source/tables", "destination_uri": "file:///target/tables",
            "resources": resources, "salt": SALT, **more}


@query("flagship_load", f"""
    SELECT c_custkey, sha256(c_name || '{SALT}') AS c_name, c_nationkey, c_mktsegment FROM customer
""")
def flagship_load(spark, sf_dir):
    """Cursor, column rules and a delete-insert; the second run re-reads a lag window."""
    dataset = new_dataset(spark, "flagship")
    spec = job("flagship", [{
        "source_table_name": "customer.parquet", "destination_table_name": "customer",
        "column_rules": {"exclude_columns": ["c_acctbal"], "pseudonymizing_columns": ["c_name"]},
        "incremental_config": {"incremental_key": "c_custkey", "lag_window": 100, "boundary_mode": "start"},
        "write_disposition_config": {"type": "merge", "strategy": "delete-insert", "config": {"primary_key": "c_custkey"}},
    }])
    for _ in range(2):
        run(spark, spec, reader=file_reader(sf_dir), dataset=dataset)
    return dataset.read("customer").drop("_row_id", "_load_id")


@query("rule_exclude", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def rule_exclude(spark, sf_dir):
    return exclude(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal", "no_such_column"])


@query("rule_pseudonymize", f"""
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR) || '{SALT}') AS o_custkey,
           sha256(o_orderstatus || '{SALT}') AS o_orderstatus, o_totalprice,
           sha256(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '{SALT}') AS o_orderdate, o_orderpriority
    FROM orders
""")
def rule_pseudonymize(spark, sf_dir):
    return pseudonymize(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate", "missing"], SALT)


@query("rule_exclude_then_pseudonymize", f"""
    SELECT s_suppkey, sha256(s_name || '{SALT}') AS s_name, s_nationkey FROM supplier
""")
def rule_exclude_then_pseudonymize(spark, sf_dir):
    return apply_rules(table(spark, sf_dir, "supplier"), ["s_acctbal"], ["s_name", "s_acctbal"], SALT)


# ---- incremental ------------------------------------------------------------------


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("incr_cursor", f"SELECT {EVENT_COLUMNS} FROM events WHERE ts > TIMESTAMP '2024-01-11 06:00:00'")
def incr_cursor(spark, sf_dir):
    return plain(new_rows(_events(spark, sf_dir), Cursor("ts"), last="2024-01-11 06:00:00"))


@query("incr_start", f"SELECT {EVENT_COLUMNS} FROM events WHERE event_id > 250")
def incr_start(spark, sf_dir):
    return plain(new_rows(_events(spark, sf_dir), Cursor("event_id", start=250)))


@query("incr_backfill", f"""
    SELECT {EVENT_COLUMNS}, 0::BIGINT AS stored_cursors FROM events
    WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'
""")
def incr_backfill(spark, sf_dir):
    """A run with an end position loads its window and stores no cursor."""
    dataset = new_dataset(spark, "backfill")
    spec = job("backfill", [{
        "source_table_name": "events.parquet", "destination_table_name": "events",
        "incremental_config": {"incremental_key": "ts", "start_position": "2024-01-05 00:00:00",
                               "end_position": "2024-01-20 12:00:00"},
        "write_disposition_config": {"type": "append"}, "source_options": {"row_id_keys": ["event_id"]},
    }])
    run(spark, spec, reader=file_reader(sf_dir), dataset=dataset)
    stored = 0 if ledger.stored_cursor(dataset, "backfill.events") is None else 1
    return plain(dataset.read("events").drop("_row_id", "_load_id").withColumn("stored_cursors", F.lit(stored).cast("long")))


@query("incr_lag_int", f"SELECT {EVENT_COLUMNS} FROM events WHERE event_id > 600 - 50")
def incr_lag_int(spark, sf_dir):
    return plain(new_rows(_events(spark, sf_dir), Cursor("event_id", start=100, lag=50), last=600))


@query("incr_lag_timestamp", f"""
    SELECT {EVENT_COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5400 SECOND
""")
def incr_lag_timestamp(spark, sf_dir):
    return plain(new_rows(_events(spark, sf_dir), Cursor("ts", lag=5400, boundary="start"), last="2024-01-15 00:00:00"))


def _boundary(name, mode, low, high):
    sql = f"""SELECT {ORDERS_COLUMNS} FROM orders
        WHERE o_orderdate {low} TIMESTAMP '1996-03-01' AND o_orderdate {high} TIMESTAMP '2000-03-01'"""

    @query(name, sql)
    def run_boundary(spark, sf_dir):
        cursor = Cursor("o_orderdate", start="1996-03-01", end="2000-03-01", boundary=mode)
        return plain(new_rows(table(spark, sf_dir, "orders"), cursor))


_boundary("incr_boundary_start_end", "start-end", ">=", "<=")
_boundary("incr_boundary_start", "start", ">=", "<")
_boundary("incr_boundary_end", "end", ">", "<=")
_boundary("incr_boundary_between", "between", ">", "<")


@query("incr_min_direction", f"""
    SELECT {ORDERS_COLUMNS} FROM orders
    WHERE o_orderdate <= TIMESTAMP '1999-06-01' AND o_orderdate > TIMESTAMP '1996-06-01'
""")
def incr_min_direction(spark, sf_dir):
    """Loading backwards: from the last value down to the end value."""
    cursor = Cursor("o_orderdate", start="1999-06-01", end="1996-06-01", boundary="start", direction="min")
    return plain(new_rows(table(spark, sf_dir, "orders"), cursor))


@query("incr_ordered_limit", f"""
    SELECT {ORDERS_COLUMNS} FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01'
    ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 40
""")
def incr_ordered_limit(spark, sf_dir):
    cursor = Cursor("o_orderdate", start="1997-01-01")
    return plain(ordered(new_rows(table(spark, sf_dir, "orders"), cursor), cursor, "desc", ["o_orderkey"], -40))


@query("incr_two_runs_state", f"""
    SELECT {ORDERS_COLUMNS}, (SELECT {sql_ts('max(o_orderdate)')} FROM orders) AS stored_cursor FROM orders
""")
def incr_two_runs_state(spark, sf_dir):
    """Two runs of one job: the first sees the orders up to 1998, the second everything; each row arrives once."""
    dataset = new_dataset(spark, "two-runs")
    spec = job("two-runs", [{
        "source_table_name": "orders.parquet", "destination_table_name": "orders",
        "incremental_config": {"incremental_key": "o_orderdate"}, "write_disposition_config": {"type": "append"},
        "source_options": {"row_id_keys": ["o_orderkey"]},
    }])
    everything = file_reader(sf_dir)

    def early(spark, uri, name, options):
        return everything(spark, uri, name, options).filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")

    run(spark, spec, reader=early, dataset=dataset)
    run(spark, spec, reader=everything, dataset=dataset)
    stored = F.lit(ledger.stored_cursor(dataset, "two-runs.orders")).cast("timestamp_ntz")
    return plain(dataset.read("orders").drop("_row_id", "_load_id").withColumn("stored_cursor", stored))


@query("incr_file_rows", f"SELECT {ORDERS_COLUMNS} FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01'")
def incr_file_rows(spark, sf_dir):
    """A row cursor inside scanned files."""
    rows = files.read_files(spark, sf_dir, "orders.parquet")
    return plain(new_rows(rows, Cursor("o_orderdate", start="1997-05-01", boundary="start")))
