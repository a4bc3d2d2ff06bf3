"""File, document and topic sources, message decoding and streams."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.uri import query_param, uri_part, with_scheme
from sluiceway.session import scratch_dir
from sluiceway.sources import documents, files, topics
from sluiceway.sources.predicates import predicate
from sluiceway.streaming import topic_stream
from suite.common import EVENT_COLUMNS, ORDERS_COLUMNS, new_dataset, plain, query, sql_ts, table

# ---- files ----------------------------------------------------------------------------


@query("scan_prefix_glob", f"""
    SELECT {ORDERS_COLUMNS} FROM orders
    UNION ALL SELECT l_orderkey, l_suppkey, l_returnflag, l_extendedprice, {sql_ts('l_shipdate')}, l_linestatus FROM lineitem
""")
def scan_prefix_glob(spark, sf_dir):
    """Two folders share the prefix and are read as one; a third does not and is left out."""
    base = scratch_dir(spark, "glob")
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate", "l_linestatus")
    orders.write.parquet(f"{base}/sales.parquet")
    lines.toDF(*orders.columns).write.parquet(f"{base}/sales.parquet.2")
    orders.write.parquet(f"{base}/other.parquet")
    return plain(files.read_files(spark, base, "sales.parquet"))


@query("scan_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv(spark, sf_dir):
    """Types are inferred from the text; the integers come back as 32-bit and are widened."""
    base = scratch_dir(spark, "csv")
    table(spark, sf_dir, "supplier").write.option("header", "true").csv(f"{base}/supplier.CSV")
    return files.read_files(spark, base, "supplier.CSV").withColumn("s_suppkey", F.col("s_suppkey").cast("long"))


@query("scan_jsonl", f"SELECT {EVENT_COLUMNS} FROM events")
def scan_jsonl(spark, sf_dir):
    base = scratch_dir(spark, "jsonl")
    events = table(spark, sf_dir, "events")
    events.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{base}/events.jsonl")
    return plain(files.read_files(spark, base, "events.jsonl", schema=events.schema))


@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def scan_parquet(spark, sf_dir):
    """Every row; only the three columns are read."""
    return files.read_files(spark, sf_dir, "lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")


@query("scan_modified_files", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_modified_files(spark, sf_dir):
    """Files written after the first scan's cursor: the nations, not the suppliers written before."""
    base = scratch_dir(spark, "modified")
    names = ["n_nationkey", "n_name", "n_regionkey"]
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int"), "s_name", "s_nationkey").toDF(*names)
    old.write.parquet(f"{base}/party.parquet.1")
    first = files.dated_files(spark, base, "party.parquet")
    cursor = first.agg(F.date_format(F.max("_modified_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    table(spark, sf_dir, "nation").write.parquet(f"{base}/party.parquet.2")
    return files.dated_files(spark, base, "party.parquet", modified_after=cursor).drop("_modified_at")


# ---- documents ------------------------------------------------------------------------

_DOCUMENT = (
    "struct(struct(hex(o_orderkey) as `$oid`) as _id, struct(cast(o_totalprice as string) as `$numberDecimal`) as price, "
    "struct(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as `$date`) as placed, "
    "struct(struct(o_orderstatus as pattern, 'i' as options) as `$regularExpression`) as status, "
    "struct(array(struct(cast(o_custkey as string) as `$numberLong`)) as keys, o_orderpriority as priority) as detail)"
)


def _export(spark, sf_dir):
    base = scratch_dir(spark, "documents")
    rows = table(spark, sf_dir, "orders").select(F.expr(f"to_json({_DOCUMENT}) as value"))
    rows.write.text(f"{base}/orders")
    return base


def _document_rows(df):
    return df.select(
        F.col("_id").alias("id"), "price", F.date_format("placed", "yyyy-MM-dd HH:mm:ss").alias("placed"), "status",
        F.col("detail.keys").getItem(0).alias("customer"), F.col("detail.priority").alias("priority"))


_DOCUMENT_SQL = """SELECT printf('%X', o_orderkey) AS id, CAST(o_totalprice AS VARCHAR) AS price,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed, o_orderstatus AS status, o_custkey AS customer,
    o_orderpriority AS priority FROM orders"""


@query("convert_extended_json", _DOCUMENT_SQL)
def convert_extended_json(spark, sf_dir):
    raw = spark.read.json(f"{_export(spark, sf_dir)}/orders")
    return _document_rows(documents.convert_extended_json(raw))


@query("scan_documents", f"{_DOCUMENT_SQL} WHERE o_orderpriority = '1-URGENT'")
def scan_documents(spark, sf_dir):
    where = F.col("detail.priority") == "1-URGENT"
    return _document_rows(documents.read_documents(spark, f"{_export(spark, sf_dir)}/orders", where=where))


@query("scan_all_collections", """
    SELECT 'customer' AS collection, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part
""")
def scan_all_collections(spark, sf_dir):
    base = scratch_dir(spark, "collections")
    for name, key, label in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name")):
        table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(label).alias("name")).write.json(f"{base}/{name}")
    found = documents.read_collections(spark, base, schema="id long, name string")
    parts = [df.select(F.lit(name).alias("collection"), "id", "name") for name, df in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("scan_range_partitions", "SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY o_orderstatus")
def scan_range_partitions(spark, sf_dir):
    split = documents.range_partitions(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 8)
    return split.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("scan_filter", f"SELECT {ORDERS_COLUMNS} FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def scan_filter(spark, sf_dir):
    return plain(table(spark, sf_dir, "orders").filter(predicate({"o_totalprice": {"$gt": 100000}, "o_orderstatus": "F"})))


_COMPARED = {
    "$eq": ("o_orderpriority", "2-HIGH", "o_orderpriority = '2-HIGH'"),
    "$ne": ("o_orderpriority", "2-HIGH", "o_orderpriority IS DISTINCT FROM '2-HIGH'"),
    "$gt": ("o_totalprice", 150000, "o_totalprice > 150000"),
    "$gte": ("o_custkey", 50, "o_custkey >= 50"),
    "$lt": ("o_totalprice", 150000, "o_totalprice < 150000"),
    "$lte": ("o_custkey", 50, "o_custkey <= 50"),
    "$in": ("o_orderstatus", ["F", "P"], "o_orderstatus IN ('F', 'P')"),
    "$nin": ("o_orderstatus", ["F", "P"], "(o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'P'))"),
}


@query("scan_filter_operators", " UNION ALL ".join(f"SELECT '{op}' AS operator, o_orderkey FROM orders WHERE {sql}" for op, (_, _, sql) in _COMPARED.items()))
def scan_filter_operators(spark, sf_dir):
    """Each comparison of a source filter, over all orders."""
    orders = table(spark, sf_dir, "orders")
    found = [orders.filter(predicate({name: {op: value}})).select(F.lit(op).alias("operator"), "o_orderkey") for op, (name, value, _) in _COMPARED.items()]
    return reduce(DataFrame.unionByName, found)


@query("scan_limit", f"SELECT {ORDERS_COLUMNS} FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 25")
def scan_limit(spark, sf_dir):
    return plain(documents.limited(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], -25))


# ---- topics ---------------------------------------------------------------------------
# Events as messages: clicks carry JSON, purchases a CSV line with a header key, signups a
# CSV line of the wrong length, views plain text, errors an array or no value at all.


def envelope(spark, sf_dir):
    event = F.col("event_type")
    key = (F.when(event.isin("purchase", "signup"), F.lit("header:k,user"))
           .when(event == "view", F.col("event_id").cast("string")))
    value = (F.when(event == "click", F.col("props"))
             .when(event == "purchase", F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(","), F.col("user_id").cast("string"), F.lit("\n")))
             .when(event == "signup", F.concat(F.lit("only "), F.col("user_id").cast("string")))
             .when(event == "view", F.concat(F.lit("seen by "), F.col("user_id").cast("string")))
             .when(F.col("value") < 10, F.lit("[1, 2]")))
    return table(spark, sf_dir, "events").select(
        event.alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), key.cast("binary").alias("key"), value.cast("binary").alias("value"))


_ENVELOPE = "event_id AS \"offset\", (user_id % 4)::INT AS partition, epoch_us(ts) // 1000 AS timestamp"
_PAYLOAD = "k long, user long"


@query("decode_json", f"SELECT CAST(props::JSON->>'k' AS BIGINT) AS k, {_ENVELOPE} FROM events WHERE event_type = 'click'")
def decode_json(spark, sf_dir):
    rows = topics.decode(envelope(spark, sf_dir), _PAYLOAD)
    return rows.filter(F.col("raw").isNull() & F.col("key").isNull()).drop("user", "raw", "key")


@query("decode_csv_header", f"SELECT event_id AS k, user_id AS user, {_ENVELOPE}, 'header:k,user' AS key FROM events WHERE event_type = 'purchase'")
def decode_csv_header(spark, sf_dir):
    rows = topics.decode(envelope(spark, sf_dir), _PAYLOAD)
    return rows.filter(F.col("raw").isNull() & F.col("key").isNotNull()).drop("raw")


@query("decode_raw_fallback", f"""
    SELECT CASE event_type WHEN 'signup' THEN 'only ' ELSE 'seen by ' END || user_id AS raw, {_ENVELOPE},
           CASE event_type WHEN 'signup' THEN 'header:k,user' ELSE event_id::VARCHAR END AS key
    FROM events WHERE event_type IN ('signup', 'view')
""")
def decode_raw_fallback(spark, sf_dir):
    return topics.decode(envelope(spark, sf_dir), _PAYLOAD).filter(F.col("raw").isNotNull()).drop("k", "user")


@query("decode_envelope", f"SELECT event_type AS kind, {_ENVELOPE}, 'outer' AS key FROM events")
def decode_envelope(spark, sf_dir):
    """Payload fields named like envelope columns lose against them."""
    messages = table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.lit("outer").cast("binary").alias("key"),
        F.to_json(F.struct(F.lit(-1).alias("offset"), F.lit("inner").alias("key"), F.col("event_type").alias("kind"))).cast("binary").alias("value"))
    return topics.decode(messages, "offset long, key string, kind string").drop("raw")


def _loose(spark, sf_dir):
    """Messages with a field outside the schema; those of errors have text where a number is declared."""
    event = F.col("event_type") == "error"
    fields = [F.when(~event, F.col("event_id")).alias("k"), F.col("user_id").alias("user")]
    value = F.when(event, F.lit('{"k":"abc"}')).otherwise(F.to_json(F.struct(*fields)))
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"))


@query("decode_undeclared", f"""
    SELECT event_id AS k, '{{"user":' || user_id || '}}' AS rest, {_ENVELOPE} FROM events WHERE event_type <> 'error'
""")
def decode_undeclared(spark, sf_dir):
    """Fields outside the schema are kept in one variant column."""
    return topics.decode(_loose(spark, sf_dir), "k long", rest="rest").withColumn("rest", F.to_json("rest")).drop("raw", "key")


@query("reject_wrong_type", """
    SELECT event_id AS "offset", '{"k":"abc"}' AS value, 'k is not bigint' AS reason FROM events WHERE event_type = 'error'
""")
def reject_wrong_type(spark, sf_dir):
    return topics.rejects(_loose(spark, sf_dir), "k long").select("offset", "value", F.col("_reject_reason").alias("reason"))


@query("reject_non_object", """
    SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset",
           CASE WHEN value < 10 THEN 'not an object' ELSE 'null value' END AS reason
    FROM events WHERE event_type = 'error'
""")
def reject_non_object(spark, sf_dir):
    return topics.rejects(envelope(spark, sf_dir)).select("topic", "partition", "offset", F.col("_reject_reason").alias("reason"))


@query("reject_malformed", """
    SELECT CASE event_type WHEN 'error' THEN 'rejected' ELSE 'good' END AS outcome,
           CASE event_type WHEN 'error' THEN '{"id": ' || event_id ELSE event_id::VARCHAR END AS content FROM events
""")
def reject_malformed(spark, sf_dir):
    """JSON lines cut off in the middle are kept aside with their text."""
    base = scratch_dir(spark, "malformed")
    line = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.when(F.col("event_type") == "error", "").otherwise("}"))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{base}/lines.jsonl")
    good, bad = files.read_json_lines(spark, base, "lines.jsonl", "id long")
    return good.select(F.lit("good").alias("outcome"), F.col("id").cast("string").alias("content")).unionByName(
        bad.select(F.lit("rejected").alias("outcome"), F.col("value").alias("content")))


@query("topic_start_timestamp", """
    SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset" FROM events e
    WHERE event_id >= (SELECT min(event_id) FROM events s WHERE s.event_type = e.event_type AND s.user_id % 4 = e.user_id % 4
                       AND s.ts >= TIMESTAMP '2024-01-20 12:00:00')
""")
def topic_start_timestamp(spark, sf_dir):
    moment = 1705752000000  # 2024-01-20 12:00:00 UTC
    return topics.from_timestamp(envelope(spark, sf_dir), moment).select("topic", "partition", "offset")


@query("topic_start_latest", """
    SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset" FROM events e
    WHERE event_id > coalesce((SELECT max(event_id) FROM events s WHERE s.event_type = e.event_type AND s.user_id % 4 = e.user_id % 4
                               AND s.ts < TIMESTAMP '2024-01-25'), -1)
""")
def topic_start_latest(spark, sf_dir):
    """Watermarks taken on 25 January, then a read of what came after them."""
    messages = envelope(spark, sf_dir)
    seen = messages.filter(F.col("timestamp") < 1706140800000)
    return topics.from_latest(messages, topics.high_watermarks(seen)).select("topic", "partition", "offset")


_BROKERS = """SELECT page_id, 'kafka://' || regexp_extract(url, '^https?://([^/?#]+)', 1) || ':9092' AS base, url FROM pages"""


@query("topic_uri_options", f"""
    SELECT page_id, substr(base, 9) AS broker, 'group-' || page_id AS group_id,
           CASE WHEN url LIKE 'https%' THEN 'SASL_SSL' ELSE 'PLAINTEXT' END AS protocol,
           CASE WHEN url LIKE 'https%' THEN 'SCRAM-SHA-512' ELSE 'PLAIN' END AS mechanism,
           CASE WHEN url LIKE 'https%' THEN 'user ' || page_id ELSE '' END AS username, 'false' AS use_avro
    FROM ({_BROKERS})
""")
def topic_uri_options(spark, sf_dir):
    """Broker URIs of every page's host, taken apart into reader options."""
    page = F.col("page_id").cast("string")
    base = F.concat(F.lit("kafka://"), F.regexp_extract("url", "^https?://([^/?#]+)", 1), F.lit(":9092?group_id=group-"), page)
    secured = F.concat(base, F.lit("&security_protocol=SASL_SSL&sasl_mechanisms=SCRAM-SHA-512&sasl_username=user%20"), page, F.lit("&sasl_password=p"))
    uri = F.when(F.col("url").startswith("https"), secured).otherwise(F.concat(base, F.lit("&security_protocol=PLAINTEXT")))
    rows = with_scheme(table(spark, sf_dir, "pages").select("page_id", uri.alias("uri")), "uri", "topic")
    return rows.select(
        "page_id", uri_part("uri", "topic", "host").alias("broker"), query_param(F.col("uri"), "group_id").alias("group_id"),
        query_param(F.col("uri"), "security_protocol", "PLAINTEXT").alias("protocol"),
        query_param(F.col("uri"), "sasl_mechanisms", "PLAIN").alias("mechanism"),
        query_param(F.col("uri"), "sasl_username", "").alias("username"), query_param(F.col("uri"), "use_avro", "false").alias("use_avro"))


# ---- streams --------------------------------------------------------------------------


def _event_files(spark, sf_dir, parts=4, copies=1):
    base = scratch_dir(spark, "stream-in")
    events = table(spark, sf_dir, "events")
    for _ in range(copies):
        events.repartition(parts, "event_id").write.mode("append").parquet(base)
    return base, events.schema


def _stream(spark, base, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)


def _run(spark, stream, dataset, write, prepare=None):
    name = f"s{uuid.uuid4().hex[:8]}"
    topic_stream.start(stream, dataset.base, name, write, scratch_dir(spark, "checkpoint"), prepare).awaitTermination()


@query("stream_available_now", f"SELECT {EVENT_COLUMNS} FROM events")
def stream_available_now(spark, sf_dir):
    """All that exists now, then the stream ends by itself."""
    dataset = new_dataset(spark, "bounded")
    _run(spark, _stream(spark, *_event_files(spark, sf_dir)), dataset, topic_stream.appender("events"))
    return plain(dataset.read("events"))


@query("stream_microbatches", "SELECT 4::BIGINT AS batches, count(*) AS events FROM events")
def stream_microbatches(spark, sf_dir):
    """One file per micro-batch: four files, four commits."""
    dataset = new_dataset(spark, "batches")
    _run(spark, _stream(spark, *_event_files(spark, sf_dir)), dataset, topic_stream.appender("events"))
    return dataset.read("events").agg(F.lit(len(dataset.commits())).cast("long").alias("batches"), F.count(F.lit(1)).alias("events"))


@query("stream_append", "SELECT event_type, count(*) AS events, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type")
def stream_append(spark, sf_dir):
    dataset = new_dataset(spark, "s-append")
    _run(spark, _stream(spark, *_event_files(spark, sf_dir)), dataset, topic_stream.appender("events"))
    return dataset.read("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("stream_upsert", f"""
    SELECT {EVENT_COLUMNS} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id) = 1
""")
def stream_upsert(spark, sf_dir):
    """The newest event of each user; late files do not overwrite newer rows."""
    dataset = new_dataset(spark, "s-upsert")
    write = topic_stream.upserter("latest", ["user_id"], {"ts": "desc"}, buckets=4)
    _run(spark, _stream(spark, *_event_files(spark, sf_dir)), dataset, write)
    return plain(dataset.read("latest"))


@query("stream_dedup_offsets", """
    SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset", value FROM events
""")
def stream_dedup_offsets(spark, sf_dir):
    """Every message is delivered twice and stored once."""
    dataset = new_dataset(spark, "s-dedup")

    def as_messages(batch):
        return batch.select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
                            F.col("event_id").alias("offset"), "value")

    files_in = _event_files(spark, sf_dir, parts=2, copies=2)
    _run(spark, _stream(spark, *files_in), dataset, topic_stream.delete_inserter("messages", buckets=4), as_messages)
    return dataset.read("messages")
