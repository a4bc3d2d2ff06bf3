"""Rejected rows of a job, and jobs that go on where they stopped, as streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluiceway.plans.runner import rejects_table, run
from sluiceway.session import scratch_dir
from sluiceway.sinks import storage
from sluiceway.streaming import topic_stream
from suite.common import new_dataset, query, sql_ts, stamp, table
from suite.reading import _event_files, _run, _stream, envelope
from suite.rules import job


def _folder(spark, label):
    base = scratch_dir(spark, label)
    return base, f"file://{base.removeprefix('file:')}"


_EVENT_LINE = """CASE WHEN event_id % 7 = 0 THEN '{"id": ' || event_id || ', "kind"' WHEN event_id % 11 = 1 THEN event_id::VARCHAR
    WHEN event_id % 13 = 2 THEN '{"id":"abc","kind":"' || event_type || '"}' END"""
_CUSTOMER_LINE = "CASE WHEN c_custkey % 5 = 0 THEN c_custkey || ',short' WHEN c_custkey % 7 = 1 THEN 'x' || c_custkey || ',\"a, b\",1.5' END"


@query("run_rejects", f"""
    WITH e AS (SELECT *, {_EVENT_LINE} AS bad FROM events), c AS (SELECT *, {_CUSTOMER_LINE} AS bad FROM customer)
    SELECT 'events' AS source, event_id AS id, event_type AS detail, NULL::VARCHAR AS reason FROM e WHERE bad IS NULL
    UNION ALL SELECT 'events', NULL, bad, CASE WHEN event_id % 7 = 0 THEN 'malformed' WHEN event_id % 11 = 1 THEN 'not an object'
        ELSE 'a value is not of the declared type' END FROM e WHERE bad IS NOT NULL
    UNION ALL SELECT 'customer', c_custkey, c_name || ', ' || c_mktsegment, NULL FROM c WHERE bad IS NULL
    UNION ALL SELECT 'customer', NULL, bad, CASE WHEN c_custkey % 5 = 0 THEN 'another number of fields'
        ELSE 'a value is not of the declared type' END FROM c WHERE bad IS NOT NULL
    UNION ALL SELECT 'messages', event_id, event_type, NULL FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'messages', NULL, CASE WHEN "value" < 10 THEN '[1, 2]' END, CASE WHEN "value" < 10 THEN 'not an object' ELSE 'null value' END
        FROM events WHERE event_type = 'error'
""")
def run_rejects(spark, sf_dir):
    """JSON lines, CSV and archived messages in one job: good rows, and rejected ones with text and reason."""
    base, uri = _folder(spark, "rejects-in")
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    n = F.col("event_id")
    good = F.to_json(F.struct(n.alias("id"), F.col("event_type").alias("kind")))
    line = (F.when(n % 7 == 0, F.concat(F.lit('{"id": '), n, F.lit(', "kind"'))).when(n % 11 == 1, n.cast("string"))
            .when(n % 13 == 2, F.concat(F.lit('{"id":"abc","kind":"'), "event_type", F.lit('"}'))).otherwise(good))
    events.select(line.alias("value")).write.text(f"{base}/events.jsonl.d")
    k = F.col("c_custkey")
    fields = F.concat(k, F.lit(',"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('",'), F.col("c_acctbal").cast("string"))
    rows = F.when(k % 5 == 0, F.concat(k, F.lit(",short"))).when(k % 7 == 1, F.concat(F.lit("x"), k, F.lit(',"a, b",1.5'))).otherwise(fields)
    customer.select(rows.alias("id,name,balance")).write.option("header", "true").option("quote", "").option("sep", "\x01").csv(f"{base}/customer.csv.d")
    envelope(spark, sf_dir).write.parquet(f"{base}/messages.parquet.d")
    dataset = new_dataset(spark, "rejects")

    def resource(name, **options):
        return {"source_table_name": name, "destination_table_name": name.split(".")[0], "write_disposition_config": {"type": "append"}, "source_options": options}

    run(spark, job("rejects", [
        resource("events.jsonl", schema="id long, kind string"), resource("customer.csv", schema="id long, name string, balance double"),
        resource("messages.parquet", payload="k long, user long"),
    ], source_uri=uri), dataset=dataset)
    loaded = [
        dataset.read("events").select(F.lit("events").alias("source"), "id", F.col("kind").alias("detail")),
        dataset.read("customer").select(F.lit("customer"), "id", "name"),
        dataset.read("messages").select("offset").join(events.select(n.alias("offset"), "event_type"), "offset").select(F.lit("messages"), "offset", "event_type"),
    ]
    out = loaded[0].union(loaded[1]).union(loaded[2]).withColumn("reason", F.lit(None).cast("string"))
    for name in ("events", "customer", "messages"):
        out = out.union(dataset.read(rejects_table(name)).select(F.lit(name), F.lit(None).cast("long"), "value", "reason"))
    return out


def _archive(spark, sf_dir, base, part, files):
    envelope(spark, sf_dir).filter(part).repartition(files).write.mode("append").parquet(f"{base}/messages.parquet.d")


def _resumed(start_from="earliest", **options):
    return [{
        "source_table_name": "messages.parquet", "destination_table_name": "messages", "write_disposition_config": {"type": "append"},
        "source_options": {"payload": "k long, user long", "resume": True, "start_from": start_from, **options},
    }]


@query("run_topic_resume", """
    SELECT event_id AS "offset", (user_id % 4)::INT AS partition, 4::BIGINT AS loads, (SELECT count(*) FROM events WHERE event_type = 'error') AS rejected
    FROM events WHERE event_type <> 'error'
""")
def run_topic_resume(spark, sf_dir):
    """Two runs of a job over a growing archive of messages, and a third without news: every message once, a file a batch."""
    base, uri = _folder(spark, "resume-in")
    dataset, spec = new_dataset(spark, "resume"), job("resume", _resumed(batch_size=1), source_uri=uri)
    for part in ("offset % 3 = 0", "offset % 3 <> 0", "false"):
        if part != "false":
            _archive(spark, sf_dir, base, part, 2)
        run(spark, spec, dataset=dataset)
    rejected = dataset.read(rejects_table("messages")).count()
    return dataset.read("messages").select("offset", "partition", F.lit(len(dataset.commits())).cast("long").alias("loads"), F.lit(rejected).cast("long").alias("rejected"))


@query("run_topic_latest", """
    SELECT event_id AS "offset", (user_id % 4)::INT AS partition FROM events
    WHERE event_type <> 'error' AND event_id > (SELECT max(event_id) // 2 FROM events)
""")
def run_topic_latest(spark, sf_dir):
    """A job that starts at the end: what is archived before its first run is left out, what comes later is loaded once."""
    base, uri = _folder(spark, "latest-in")
    half = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
    dataset, spec = new_dataset(spark, "latest"), job("latest", _resumed("latest"), source_uri=uri)
    for part in (f"offset <= {half}", f"offset > {half}"):
        _archive(spark, sf_dir, base, part, 2)
        run(spark, spec, dataset=dataset)
    return dataset.read("messages").select("offset", "partition")


def _at_rank(rows, column, rank, bins=1024):
    """The whole number at a place (from 0) of the sorted column: the range that holds it is cut into ever smaller ones by their counts, no row is collected."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) // bins + 1
        counts = rows.filter(F.col(column).between(low, high)).groupBy(F.expr(f"({column} - ({low}L)) div {width}L").alias("bin")).count()
        for found in sorted(counts.collect()):  # at most `bins` rows
            if rank < found["count"]:
                break
            rank -= found["count"]
        low, high = low + found["bin"] * width, min(high, low + (found["bin"] + 1) * width - 1)
    return low


@query("run_topic_since", """
    WITH e AS (SELECT event_id, event_type, user_id % 4 AS p, epoch_us(ts) // 1000 AS ms FROM events),
    t AS (SELECT ms AS since FROM e ORDER BY ms LIMIT 1 OFFSET (SELECT count(*) // 2 FROM e)),
    s AS (SELECT event_type, p, min(event_id) AS first FROM e, t WHERE ms >= since GROUP BY 1, 2)
    SELECT event_id AS "offset", p::INT AS partition FROM e JOIN s USING (event_type, p) WHERE event_id >= first AND event_type <> 'error'
""")
def run_topic_since(spark, sf_dir):
    """A bounded run over the archive from a time on: every partition from its first message that is not older."""
    base, uri = _folder(spark, "since-in")
    _archive(spark, sf_dir, base, "true", 3)
    times = envelope(spark, sf_dir).select("timestamp")
    since = _at_rank(times, "timestamp", times.count() // 2)
    dataset = new_dataset(spark, "since")
    run(spark, job("since", _resumed(f"timestamp:{since}", resume=False), source_uri=uri), dataset=dataset)
    return dataset.read("messages").select("offset", "partition")


@query("run_late_file", "SELECT o_orderkey AS id, o_orderpriority AS priority, 2::BIGINT AS loads FROM orders")
def run_late_file(spark, sf_dir):
    """Files come late, with a time long before those that were loaded: each is loaded once."""
    base, uri = _folder(spark, "late-in")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    dataset = new_dataset(spark, "late")
    spec = job("late", [{"source_table_name": "orders.parquet", "destination_table_name": "orders", "write_disposition_config": {"type": "append"},
                         "source_options": {"resume": True, "schema": "id long, priority string"}}], source_uri=uri)
    for k, part in enumerate(("id % 2 = 0", "id % 2 = 1")):
        orders.filter(part).coalesce(2).write.parquet(f"{base}/orders.parquet.{k}")
        if k:
            for name in storage.files_in(spark, f"{base}/orders.parquet.{k}"):
                storage.set_time(spark, name, 1_000_000_000_000)
        run(spark, spec, dataset=dataset)
    run(spark, spec, dataset=dataset)
    return dataset.read("orders").select("id", "priority", F.lit(len(dataset.commits())).cast("long").alias("loads"))


@query("stream_upsert_hard_delete", f"""
    SELECT user_id, event_id, {sql_ts('ts')} AS ts, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1 AND event_type <> 'error'
""")
def stream_upsert_hard_delete(spark, sf_dir):
    """Errors delete their user; files come in any order, so an older event must not bring a deleted user back."""
    dataset = new_dataset(spark, "s-delete")
    write = topic_stream.upserter("latest", ["user_id"], {"ts": "desc", "event_id": "desc"}, "gone", buckets=4)
    as_changes = lambda batch: batch.select("user_id", "event_id", "ts", "event_type", (F.col("event_type") == "error").alias("gone"))
    _run(spark, _stream(spark, *_event_files(spark, sf_dir)), dataset, write, as_changes)
    return dataset.read("latest").select("user_id", "event_id", stamp("ts").alias("ts"), "event_type")


@query("stream_upsert_partial", f"""
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT user_id, max(n) AS newest, {sql_ts('max(ts)')} AS ts, max_by(event_type, n) FILTER (event_id % 2 = 0) AS even_type,
        max_by("value", n) FILTER (event_id % 2 = 1) AS odd_value
    FROM e GROUP BY user_id
""")
def stream_upsert_partial(spark, sf_dir):
    """Two streams, even and odd events, each with columns of its own; the one column of the other stays and may come late."""
    dataset = new_dataset(spark, "s-partial")
    events = table(spark, sf_dir, "events")
    base = scratch_dir(spark, "partial-in")
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("newest")
    numbered = events.select("user_id", "event_id", "ts", "event_type", "value", order)
    for k, columns in enumerate((["event_type as even_type"], ["value as odd_value"])):
        part = numbered.filter(F.col("event_id") % 2 == k).selectExpr("user_id", "newest", "ts", *columns)
        part.repartition(3, "ts").write.parquet(f"{base}/{k}")
        write = topic_stream.upserter("latest", ["user_id"], {"newest": "desc"}, buckets=4)
        _run(spark, _stream(spark, f"{base}/{k}", part.schema), dataset, write)
    return dataset.read("latest").select("user_id", F.col("newest").cast("long").alias("newest"), stamp("ts").alias("ts"), "even_type", "odd_value")
