"""Names, types, nested data, identities, ledger and schema versions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluiceway.functions.names import snake_columns
from sluiceway.operators.normalize import detect_iso_timestamps, evolve_union, flatten, relational, with_load_id, with_row_id
from sluiceway.plans.runner import run
from sluiceway.sinks import ledger
from suite.common import new_dataset, plain, query, sql_ts, table
from suite.rules import file_reader, job


@query("norm_snake_case", """
    SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_id, p_type AS part_type, p_size AS size_in_cm,
           p_retailprice AS retail_price FROM part
""")
def norm_snake_case(spark, sf_dir):
    return snake_columns(table(spark, sf_dir, "part").toDF("PartKey", "Part Name", "brandID", "part-type", "Size (in cm)", "retailPrice"))


@query("norm_iso_timestamps", f"SELECT event_id, {sql_ts('ts')} AS ts, event_type, event_type AS same, CAST(event_id AS VARCHAR) AS code FROM events")
def norm_iso_timestamps(spark, sf_dir):
    """Only the text column whose every value is an ISO date-time becomes a timestamp."""
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "event_type",
        F.col("event_type").alias("same"), F.col("event_id").cast("string").alias("code"))
    return plain(detect_iso_timestamps(texts))


@query("norm_flatten", """
    SELECT o_orderkey AS id, o_orderstatus AS state__code, o_orderpriority AS state__detail__priority,
           o_totalprice AS state__detail__total_price FROM orders
""")
def norm_flatten(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("code"),
                 F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("totalPrice")).alias("detail")).alias("state"))
    return flatten(nested)


@query("norm_child_table", """
    SELECT doc_id, list_idx, line, length(line)::INT AS chars FROM (
        SELECT doc_id, unnest(range(len(l)))::INT AS list_idx, unnest(l) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
""")
def norm_child_table(spark, sf_dir):
    """Documents with their lines as a list of objects; the child table gives back every line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("parts"))
    nested = docs.select("doc_id", F.transform("parts", lambda p: F.struct(p.alias("line"), F.length(p).alias("chars"))).alias("body"))
    tables = relational(with_row_id(nested, keys=["doc_id"]), "doc")
    roots = tables["doc"].select("doc_id", F.col("_row_id").alias("__id"))
    return tables["doc__body"].join(roots, F.col("_parent_id") == F.col("__id")).select(
        "doc_id", F.col("_list_idx").alias("list_idx"), "line", "chars")


@query("norm_row_id", """
    SELECT l_orderkey, l_linenumber, count(*) AS row_ids FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem)
    GROUP BY l_orderkey, l_linenumber
""")
def norm_row_id(spark, sf_dir):
    """Every row twice, and many rows alike: as many ids as rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    ids = with_row_id(lines.unionByName(lines), load_id="load-1").select("l_orderkey", "l_linenumber", F.unhex("_row_id").alias("id"))
    # the ids of a key, in order, are counted as they pass: one sort of partitions that lie by key already, no table of all ids in memory
    of_key = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("id")
    numbered = ids.withColumns({"row_ids": F.dense_rank().over(of_key).cast("long"), "__next": F.lead("id").over(of_key)})
    return numbered.filter(F.col("__next").isNull()).select("l_orderkey", "l_linenumber", "row_ids")


@query("norm_load_id", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'load-7' AS _load_id FROM supplier")
def norm_load_id(spark, sf_dir):
    return with_load_id(table(spark, sf_dir, "supplier"), "load-7")


@query("norm_evolve_union", """
    SELECT p_partkey AS key, p_name AS name, p_size::VARCHAR AS size, p_retailprice AS price, '-' AS nation FROM part
    UNION ALL SELECT s_suppkey, s_name, 'n/a', s_acctbal, s_nationkey::VARCHAR FROM supplier
""")
def norm_evolve_union(spark, sf_dir):
    """A new column, an absent one and two widened ones."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("n/a").alias("size"), F.col("s_acctbal").alias("price"),
        F.col("s_nationkey").cast("string").alias("nation"))
    return evolve_union(parts, suppliers).withColumn("nation", F.coalesce("nation", F.lit("-")))


# ---- ledger ---------------------------------------------------------------------------


def _two_loads(spark, sf_dir):
    """Orders without their priority, then with it; suppliers once."""
    dataset = new_dataset(spark, "ledger")
    read = file_reader(sf_dir)

    def narrow(spark, uri, name, options):
        df = read(spark, uri, name, options)
        return df.drop("o_orderpriority") if name.startswith("orders") else df

    def resource(name, key):
        return {"source_table_name": f"{name}.parquet", "destination_table_name": name,
                "write_disposition_config": {"type": "append"}, "source_options": {"row_id_keys": [key]}}

    orders, supplier = resource("orders", "o_orderkey"), resource("supplier", "s_suppkey")
    run(spark, job("sales", [orders, supplier]), reader=narrow, dataset=dataset)
    run(spark, job("sales", [orders]), reader=read, dataset=dataset)
    return dataset


@query("ledger_loads", """
    SELECT 'sales' AS schema_name, 0 AS status, 'orders' AS table_name, n AS rows_written, 2::BIGINT AS loads FROM (SELECT count(*) AS n FROM orders)
    UNION ALL SELECT 'sales', 0, 'supplier', n, 1 FROM (SELECT count(*) AS n FROM supplier)
""")
def ledger_loads(spark, sf_dir):
    loads = ledger.loads(_two_loads(spark, sf_dir))
    return loads.groupBy("schema_name", "status", "table_name", "rows_written").agg(F.countDistinct("load_id").alias("loads"))


@query("schema_versions", """
    SELECT 'orders' AS table_name, 1::BIGINT AS schema_version, 0 AS previous, 7 AS columns, (SELECT count(*) FROM orders) * 2 AS stored_rows
    UNION ALL SELECT 'orders', 2, 1, 8, (SELECT count(*) FROM orders) * 2
    UNION ALL SELECT 'supplier', 1, 0, 6, (SELECT count(*) FROM supplier)
""")
def schema_versions(spark, sf_dir):
    """The added column makes a second version that names the first as its predecessor."""
    dataset = _two_loads(spark, sf_dir)
    versions = ledger.schema_versions(dataset)
    counts = dataset.read("orders").agg(F.lit("orders").alias("t"), F.count(F.lit(1)).alias("stored_rows")).unionByName(
        dataset.read("supplier").agg(F.lit("supplier").alias("t"), F.count(F.lit(1)).alias("stored_rows")))
    columns = F.size(F.from_json("schema", "fields array<struct<name string>>")["fields"])
    return versions.join(counts, F.col("table_name") == F.col("t")).select(
        "table_name", "schema_version", F.size("previous_hashes").alias("previous"), columns.alias("columns"), "stored_rows")


@query("job_result", """
    SELECT 'success' AS status, 'Data ingestion completed' AS message, 'sales' AS pipeline_name, true AS hashed, true AS newest,
           (SELECT count(*) FROM orders) AS rows_written
""")
def job_result(spark, sf_dir):
    dataset = _two_loads(spark, sf_dir)
    result = ledger.job_result(dataset)
    loads = ledger.loads(dataset)
    newest = loads.groupBy(F.col("schema_name").alias("pipeline_name")).agg(
        F.max_by("load_id", "inserted_at").alias("last"), F.max_by("rows_written", "inserted_at").alias("rows_written"))
    return result.join(newest, "pipeline_name").select(
        "status", "message", "pipeline_name", (F.length("schema_version_hash") == 64).alias("hashed"),
        (F.col("load_id") == F.col("last")).alias("newest"), "rows_written")


@query("job_multi_resource", """
    SELECT 'customer' AS loaded, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation
""")
def job_multi_resource(spark, sf_dir):
    """One job, three tables, three dispositions, run twice."""
    dataset = new_dataset(spark, "multi")
    spec = job("multi", [
        {"source_table_name": "customer.parquet", "destination_table_name": "customer",
         "write_disposition_config": {"type": "merge", "strategy": "upsert", "config": {"upsert_config": {"primary_key": "c_custkey"}}}},
        {"source_table_name": "supplier.parquet", "destination_table_name": "supplier",
         "write_disposition_config": {"type": "merge", "strategy": "scd2", "config": {"scd2_config": {}}}},
        {"source_table_name": "nation.parquet", "destination_table_name": "nation"},
    ])
    for _ in range(2):
        run(spark, spec, reader=file_reader(sf_dir), dataset=dataset)
    parts = [("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name")]
    frames = [dataset.read(t).select(F.lit(t).alias("loaded"), F.col(k).cast("long").alias("id"), F.col(n).alias("name")) for t, k, n in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("sink_parquet_roundtrip", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           {sql_ts('l_shipdate')} AS l_shipdate FROM lineitem
""")
def sink_parquet_roundtrip(spark, sf_dir):
    dataset = new_dataset(spark, "roundtrip")
    dataset.commit([dataset.append("lineitem", table(spark, sf_dir, "lineitem"))])
    return plain(dataset.read("lineitem"))
