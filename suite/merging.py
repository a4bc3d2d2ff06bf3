"""Append, replace, the merge family and type-2 history."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators import merge as merges
from sluiceway.operators.dedup import dedup
from sluiceway.operators.normalize import relational, with_row_id
from sluiceway.operators.scd2 import Scd2, boundary_time, scd2
from sluiceway.sinks.replace import replace_tables
from suite.common import ORDERS_COLUMNS, new_dataset, plain, query, sql_ts, table

# ---- append and replace -------------------------------------------------------------


@query("write_append", "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT s_suppkey::INT, s_name, s_nationkey FROM supplier")
def write_append(spark, sf_dir):
    dataset = new_dataset(spark, "append")
    dataset.commit([dataset.append("nation", table(spark, sf_dir, "nation"))])
    more = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("n_nationkey"), F.col("s_name").alias("n_name"), F.col("s_nationkey").alias("n_regionkey"))
    dataset.commit([dataset.append("nation", more)])
    return dataset.read("nation")


def _replaced(spark, sf_dir, strategy):
    """Orders with their lines replaced by the customers with their own summary rows."""
    dataset = new_dataset(spark, "replace")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    replace_tables(dataset, {"root": orders.select("o_orderkey", "o_orderstatus"), "root__child": lines.select("l_orderkey")}, strategy)
    new_root = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("balance"))
    new_child = table(spark, sf_dir, "events").select(F.col("user_id").alias("l_orderkey"))
    replace_tables(dataset, {"root": new_root, "root__child": new_child}, strategy)
    root = dataset.read("root")
    children = dataset.read("root__child").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("children"))
    root = root.fillna({"o_orderstatus": "-"}) if "o_orderstatus" in root.columns else root
    joined = root.join(children, root["o_orderkey"] == children["l_orderkey"], "left").drop("l_orderkey")
    return joined.withColumn("children", F.coalesce("children", F.lit(0).cast("long")))


_REPLACED = """SELECT c_custkey AS o_orderkey, {kept} c_acctbal AS balance,
    (SELECT count(*) FROM events WHERE user_id = c_custkey) AS children FROM customer"""
_KEPT = "'-' AS o_orderstatus,"


@query("write_replace_truncate", _REPLACED.format(kept=_KEPT))
def write_replace_truncate(spark, sf_dir):
    return _replaced(spark, sf_dir, "truncate-and-insert")


@query("write_replace_staging", _REPLACED.format(kept=_KEPT))
def write_replace_staging(spark, sf_dir):
    return _replaced(spark, sf_dir, "insert-from-staging")


@query("write_replace_optimized", _REPLACED.format(kept=""))
def write_replace_optimized(spark, sf_dir):
    return _replaced(spark, sf_dir, "staging-optimized")


# ---- dedup ---------------------------------------------------------------------------

_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_LINE_OUT = f"l_orderkey, l_linenumber, {_LINE_REST}, {sql_ts('l_shipdate')} AS l_shipdate"


def _first_lines(order):
    return f"""SELECT {_LINE_OUT} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


@query("dedup_pk", _first_lines(f"{_LINE_REST}, lineitem.l_shipdate"))
def dedup_pk(spark, sf_dir):
    return plain(dedup(table(spark, sf_dir, "lineitem"), _LINE_KEYS))


@query("dedup_sort_asc", _first_lines(f"lineitem.l_shipdate ASC, {_LINE_REST}"))
def dedup_sort_asc(spark, sf_dir):
    return plain(dedup(table(spark, sf_dir, "lineitem"), _LINE_KEYS, {"l_shipdate": "asc"}))


@query("dedup_sort_desc", _first_lines(f"lineitem.l_shipdate DESC, {_LINE_REST}"))
def dedup_sort_desc(spark, sf_dir):
    return plain(dedup(table(spark, sf_dir, "lineitem"), _LINE_KEYS, {"l_shipdate": "desc"}))


# ---- delete-insert -------------------------------------------------------------------
# Orders are the target. The incoming rows are order lines read as newer order records
# (many per key), or events read as orders.

_STATUS = {"o_orderkey": "l_orderkey", "o_orderstatus": "l_returnflag", "o_totalprice": "l_extendedprice",
           "o_orderdate": "l_shipdate"}


def _lines_as_orders(spark, sf_dir, *extra):
    renamed = [F.col(old).alias(new) for new, old in _STATUS.items()]
    return table(spark, sf_dir, "lineitem").select(*renamed, *extra)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*_STATUS)


_NEWEST = """newest AS (
    SELECT l_orderkey AS o_orderkey, l_returnflag AS o_orderstatus, l_extendedprice AS o_totalprice,
           l_shipdate AS o_orderdate, {flag} AS flag
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, l_returnflag, l_extendedprice {tie}) = 1)"""
_OUT = f"o_orderkey, o_orderstatus, o_totalprice, {sql_ts('o_orderdate')} AS o_orderdate"
_KEPT_ORDERS = f"SELECT {_OUT} FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"


@query("merge_delete_insert_pk", f"WITH {_NEWEST.format(flag='false', tie='')} {_KEPT_ORDERS} UNION ALL SELECT {_OUT} FROM newest")
def merge_delete_insert_pk(spark, sf_dir):
    return plain(merges.delete_insert(
        _orders(spark, sf_dir), _lines_as_orders(spark, sf_dir), "o_orderkey", dedup_sort={"o_orderdate": "desc"}))


def _events_as_orders(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("o_orderkey"), F.col("user_id").alias("o_custkey"), F.col("event_type").alias("o_orderstatus"),
        F.col("value").alias("o_totalprice"), F.col("ts").alias("o_orderdate"), F.lit("event").alias("o_orderpriority"))


_EVENTS_AS_ORDERS = f"""SELECT event_id AS o_orderkey, user_id AS o_custkey, event_type AS o_orderstatus,
    value AS o_totalprice, {sql_ts('ts')} AS o_orderdate, 'event' AS o_orderpriority FROM events"""


@query("merge_delete_insert_merge_key", f"""
    SELECT {ORDERS_COLUMNS} FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)
    UNION ALL {_EVENTS_AS_ORDERS}
""")
def merge_delete_insert_merge_key(spark, sf_dir):
    return plain(merges.delete_insert(table(spark, sf_dir, "orders"), _events_as_orders(spark, sf_dir), merge_key="o_custkey"))


@query("merge_delete_insert_both", f"""
    SELECT {ORDERS_COLUMNS} FROM orders
    WHERE o_orderkey NOT IN (SELECT event_id FROM events) AND o_custkey NOT IN (SELECT user_id FROM events)
    UNION ALL {_EVENTS_AS_ORDERS}
""")
def merge_delete_insert_both(spark, sf_dir):
    return plain(merges.delete_insert(
        table(spark, sf_dir, "orders"), _events_as_orders(spark, sf_dir), primary_key="o_orderkey", merge_key="o_custkey"))


@query("merge_hard_delete_bool", f"""
    WITH {_NEWEST.format(flag="l_returnflag = 'R'", tie=", l_returnflag = 'R'")}
    {_KEPT_ORDERS} UNION ALL SELECT {_OUT} FROM newest WHERE NOT flag
""")
def merge_hard_delete_bool(spark, sf_dir):
    incoming = _lines_as_orders(spark, sf_dir, (F.col("l_returnflag") == "R").alias("is_deleted"))
    merged = merges.delete_insert(_orders(spark, sf_dir), incoming, "o_orderkey", None, "is_deleted", {"o_orderdate": "desc"})
    return plain(merged.drop("is_deleted"))


@query("merge_hard_delete_nonnull", f"""
    WITH {_NEWEST.format(flag="nullif(l_linestatus, 'O')", tie=", nullif(l_linestatus, 'O') NULLS LAST")}
    {_KEPT_ORDERS} UNION ALL SELECT {_OUT} FROM newest WHERE flag IS NULL
""")
def merge_hard_delete_nonnull(spark, sf_dir):
    incoming = _lines_as_orders(spark, sf_dir, F.nullif(F.col("l_linestatus"), F.lit("O")).alias("deleted_at"))
    merged = merges.delete_insert(_orders(spark, sf_dir), incoming, "o_orderkey", None, "deleted_at", {"o_orderdate": "desc"})
    return plain(merged.drop("deleted_at"))


# ---- upsert --------------------------------------------------------------------------
# Customers are the target; incoming are per-user facts from events, and suppliers
# under keys no customer has.


def _user_facts(spark, sf_dir):
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.max("value").alias("c_acctbal"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.when(F.col("s_acctbal") < 0, "error").otherwise("supplier").alias("last_type"))
    return users.unionByName(suppliers)


_FACTS_OUT = "SELECT c_custkey, coalesce(c_name, '-') AS c_name, coalesce(c_nationkey, -1) AS c_nationkey, c_acctbal, coalesce(c_mktsegment, '-') AS c_mktsegment"
_FACTS = """facts AS (
    SELECT user_id AS c_custkey, max(value) AS c_acctbal, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id
    UNION ALL SELECT -1 - s_suppkey, s_acctbal, CASE WHEN s_acctbal < 0 THEN 'error' ELSE 'supplier' END FROM supplier)"""
_OLD_CUSTOMERS = "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM facts)"


def _shown(customers):
    return customers.fillna({"c_name": "-", "c_nationkey": -1, "c_mktsegment": "-"})


@query("merge_upsert", f"""
    WITH {_FACTS} {_FACTS_OUT} FROM ({_OLD_CUSTOMERS}
    UNION ALL SELECT f.c_custkey, c.c_name, c.c_nationkey, f.c_acctbal, c.c_mktsegment
    FROM facts f LEFT JOIN customer c USING (c_custkey))
""")
def merge_upsert(spark, sf_dir):
    """Known keys are updated in the columns that arrive, unknown keys inserted."""
    return _shown(merges.upsert(table(spark, sf_dir, "customer"), _user_facts(spark, sf_dir).drop("last_type"), "c_custkey"))


@query("merge_upsert_hard_delete", f"""
    WITH {_FACTS} {_FACTS_OUT} FROM ({_OLD_CUSTOMERS}
    UNION ALL SELECT f.c_custkey, c.c_name, c.c_nationkey, f.c_acctbal, c.c_mktsegment
    FROM facts f LEFT JOIN customer c USING (c_custkey) WHERE last_type <> 'error')
""")
def merge_upsert_hard_delete(spark, sf_dir):
    """Users whose last event is an error are deleted; flagged unknown suppliers have no effect."""
    facts = _user_facts(spark, sf_dir).withColumn("gone", F.col("last_type") == "error").drop("last_type")
    return _shown(merges.upsert(table(spark, sf_dir, "customer"), facts, "c_custkey", "gone").drop("gone"))


@query("merge_composite_key", f"""
    WITH target AS (
        SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice) = 1),
    incoming AS (
        SELECT o_orderkey AS l_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 1 ELSE 9 END AS l_linenumber,
               o_totalprice AS l_extendedprice FROM orders)
    SELECT t.l_orderkey, coalesce(t.l_linenumber, -1) AS l_linenumber, t.l_extendedprice FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.l_orderkey = t.l_orderkey AND i.l_linenumber IS NOT DISTINCT FROM t.l_linenumber)
    UNION ALL SELECT l_orderkey, coalesce(l_linenumber, -1), l_extendedprice FROM incoming
""")
def merge_composite_key(spark, sf_dir):
    """A two-column key whose second part may be NULL."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    target = dedup(lines, _LINE_KEYS).withColumn("l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(7)))
    number = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 9)
    incoming = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), number.alias("l_linenumber"), F.col("o_totalprice").alias("l_extendedprice"))
    merged = merges.upsert(target, incoming, _LINE_KEYS)
    return merged.withColumn("l_linenumber", F.coalesce("l_linenumber", F.lit(-1)))


# ---- child tables --------------------------------------------------------------------


@query("merge_child_tables", """
    WITH roots AS (
        SELECT doc_id AS id, lang AS title, string_split(text, chr(10)) AS l FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages)
        UNION ALL SELECT page_id, url, string_split(html, '>') FROM pages)
    SELECT id, -1 AS list_idx, title AS line FROM roots
    UNION ALL SELECT id, unnest(range(len(l)))::INT, unnest(l) FROM roots
""")
def merge_child_tables(spark, sf_dir):
    """Documents and their lines, then a delete-insert of pages and their pieces under the same keys; children follow."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.split("text", "\n").alias("body"))
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("title"), F.split("html", ">").alias("body"))
    old = relational(with_row_id(docs, keys=["id"]), "text")
    new = relational(with_row_id(pages, keys=["id"]), "text")
    root = merges.delete_insert(old["text"], new["text"], "id")
    children = merges.merge_children(old["text__body"], new["text__body"], new["text"].select("_row_id"))
    ids = root.select("id", F.col("_row_id").alias("__id"))
    lines = children.join(ids, F.col("_root_id") == F.col("__id")).select("id", F.col("_list_idx").alias("list_idx"), F.col("value").alias("line"))
    return root.select("id", F.lit(-1).alias("list_idx"), F.col("title").alias("line")).unionByName(lines)


# ---- type 2 --------------------------------------------------------------------------
# Day 0 is every order. Day 1: open orders are finished, pending ones are gone, and
# suppliers appear as new orders. Day 2 is day 0 again.

_DAYS = ["2024-01-01 10:20:30.123456", "2024-02-01 10:20:30.5", "2024-03-01 10:20:30"]
_T = [f"{d[:19]}.{(d[20:] + '000000')[:6]}" for d in _DAYS]
_FAR = "9999-12-31 00:00:00.000000"


def _day0(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _new_orders(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("o_orderkey"), F.col("s_nationkey").cast("long").alias("o_custkey"),
        F.lit("N").alias("o_orderstatus"), F.col("s_acctbal").alias("o_totalprice"),
        F.lit("2001-09-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))


def _day1(spark, sf_dir):
    finished = F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus"))
    kept = _day0(spark, sf_dir).filter(F.col("o_orderstatus") != "P").withColumn("o_orderstatus", finished)
    return kept.unionByName(_new_orders(spark, sf_dir))


_DAY1 = """day1 AS (
    SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT -1 - s_suppkey, s_nationkey::BIGINT, 'N', s_acctbal, TIMESTAMP '2001-09-01', '1-URGENT' FROM supplier)"""


def _span(start, end):
    return f"'{start}' AS valid_from, '{end}' AS valid_to"


# orders by what day 1 does to them: F stays, O changes, P is absent
_SNAPSHOT = f"""
    SELECT {ORDERS_COLUMNS}, {_span(_T[0], '{far}')} FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[0], _T[1])} FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[1], '{far}')} FROM (SELECT * FROM day1
        WHERE o_orderstatus = 'N' OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))"""


def _two_days(spark, sf_dir, cfg, second=None, minute=False):
    first = scd2(None, _day0(spark, sf_dir), boundary_time(_DAYS[0], minute), cfg)
    return scd2(first, second if second is not None else _day1(spark, sf_dir), boundary_time(_DAYS[1], minute), cfg)


@query("scd2_snapshot", f"WITH {_DAY1} {_SNAPSHOT.format(far=_FAR)}")
def scd2_snapshot(spark, sf_dir):
    return plain(_two_days(spark, sf_dir, Scd2()))


@query("scd2_three_runs", f"""
    WITH {_DAY1}
    SELECT {ORDERS_COLUMNS}, {_span(_T[0], _FAR)} FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[0], _T[1])} FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[1], _T[2])} FROM (SELECT * FROM day1
        WHERE o_orderstatus = 'N' OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[2], _FAR)} FROM orders WHERE o_orderstatus <> 'F'
""")
def scd2_three_runs(spark, sf_dir):
    """Three snapshots into a stored table; history is appended, never rewritten."""
    dataset = new_dataset(spark, "scd2")
    days = [_day0(spark, sf_dir), _day1(spark, sf_dir), _day0(spark, sf_dir)]
    for at, rows in zip(_DAYS, days):
        dataset.commit([dataset.merge_scd2("orders", rows, boundary_time(at))])
    return plain(dataset.read("orders"))


@query("scd2_natural_key", f"""
    WITH {_DAY1}
    SELECT {ORDERS_COLUMNS}, {_span(_T[0], _FAR)} FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[0], _T[1])} FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[1], _FAR)} FROM (SELECT * FROM day1
        WHERE o_orderstatus = 'N' OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))
""")
def scd2_natural_key(spark, sf_dir):
    """Absent pending orders stay active, because their key did not arrive."""
    return plain(_two_days(spark, sf_dir, Scd2(natural_key=["o_orderkey"])))


@query("scd2_partition_key", f"""
    WITH {_DAY1}, loaded AS (SELECT * FROM day1 WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
    SELECT {ORDERS_COLUMNS}, {_span(_T[0], _FAR)} FROM orders
    WHERE o_orderstatus = 'F' OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[0], _T[1])} FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT {ORDERS_COLUMNS}, {_span(_T[1], _FAR)} FROM (SELECT * FROM loaded
        WHERE o_orderstatus = 'N' OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'))
""")
def scd2_partition_key(spark, sf_dir):
    """Only the two loaded priorities retire what is absent."""
    loaded = _day1(spark, sf_dir).filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return plain(_two_days(spark, sf_dir, Scd2(partition_key=["o_orderpriority"]), loaded))


@query("scd2_custom_columns", f"""
    WITH {_DAY1}, state AS ({_SNAPSHOT.format(far=_FAR)})
    SELECT * EXCLUDE (valid_from, valid_to), valid_from AS seen_from, valid_to AS seen_until FROM state
""")
def scd2_custom_columns(spark, sf_dir):
    return plain(_two_days(spark, sf_dir, Scd2(columns=["seen_from", "seen_until"])))


@query("scd2_active_sentinel", f"WITH {_DAY1} {_SNAPSHOT.format(far='2999-01-01 00:00:00.000000')}")
def scd2_active_sentinel(spark, sf_dir):
    return plain(_two_days(spark, sf_dir, Scd2(active_until="2999-01-01")))


@query("scd2_active_null", f"""
    WITH {_DAY1}, state AS ({_SNAPSHOT.format(far='open')})
    SELECT * FROM state
""")
def scd2_active_null(spark, sf_dir):
    return plain(_two_days(spark, sf_dir, Scd2(active_until=None))).fillna({"valid_to": "open"})


@query("scd2_boundary_minute", f"""
    WITH {_DAY1}, state AS ({_SNAPSHOT.format(far=_FAR)})
    SELECT * REPLACE (valid_from[1:16] || ':00.000000' AS valid_from, valid_to[1:16] || ':00.000000' AS valid_to) FROM state
""")
def scd2_boundary_minute(spark, sf_dir):
    return plain(_two_days(spark, sf_dir, Scd2(), minute=True))
