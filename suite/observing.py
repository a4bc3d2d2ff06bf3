"""Run metrics over a step log made from the events.

A run is one user's day. Clicks are finished extract steps, views normalize, purchases
load, errors failed normalize steps and signups load steps still open.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators import observe
from suite.common import plain, query, sql_ts, table

_RUN = "user_id || '-' || strftime(ts, '%Y%m%d')"
_STEP = "CASE event_type WHEN 'click' THEN 'extract' WHEN 'view' THEN 'normalize' WHEN 'error' THEN 'normalize' ELSE 'load' END"
_K = "CAST(props::JSON->>'k' AS INTEGER)"
_LOG = f"""log AS (
    SELECT {_RUN} AS run_id, {_STEP} AS step, event_type, event_id, ts AS started_at, value, {_K} AS k,
           CASE WHEN event_type <> 'signup' THEN ts + to_seconds({_K}) END AS finished_at,
           CASE WHEN event_type = 'error' THEN 'failed with ' || {_K} END AS error,
           CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'Files' WHEN 'error' THEN '_pipeline_state'
                WHEN 'purchase' THEN 'sales' ELSE 'Resources' END AS name,
           CASE WHEN event_type = 'view' THEN 'file-' || {_K} WHEN event_type = 'purchase' AND {_K} > 50 THEN 'big' END AS label,
           {_K}::BIGINT AS row_count, ({_K} * 100)::BIGINT AS file_size, 1 AS inc
    FROM events)"""


def _log(spark, sf_dir):
    event = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    step = F.when(event == "click", "extract").when(event.isin("view", "error"), "normalize").otherwise("load")
    name = (F.when(event == "click", "clicks").when(event == "view", "Files").when(event == "error", "_pipeline_state")
            .when(event == "purchase", "sales").otherwise("Resources"))
    label = F.when(event == "view", F.concat(F.lit("file-"), k.cast("string"))).when((event == "purchase") & (k > 50), "big")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("run_id"), step.alias("step"),
        F.lit("events").alias("pipeline_name"), F.lit("file").alias("source_type"), F.lit("dataset").alias("destination_type"),
        event, "event_id", F.col("ts").alias("started_at"), k.alias("k"),
        F.when(event != "signup", (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k))).alias("finished_at"),
        F.when(event == "error", F.concat(F.lit("failed with "), k.cast("string"))).alias("error"),
        name.alias("name"), label.alias("label"), k.cast("long").alias("row_count"), (k * 100).cast("long").alias("file_size"),
        F.lit(1).alias("inc"), F.col("ts").alias("at"))


_SUM = f"""WITH {_LOG} SELECT run_id, name, sum(row_count)::BIGINT AS row_count, sum(file_size)::BIGINT AS file_size
    FROM log WHERE step = '{{step}}' AND name NOT IN ('_pipeline_state', 'Resources') GROUP BY run_id, name"""


@query("metrics_rows_per_resource", _SUM.format(step="extract"))
def metrics_rows_per_resource(spark, sf_dir):
    return observe.rows_per_table(_log(spark, sf_dir), "extract")


@query("metrics_rows_per_table", _SUM.format(step="normalize"))
def metrics_rows_per_table(spark, sf_dir):
    return observe.rows_per_table(_log(spark, sf_dir), "normalize")


@query("metrics_load_duration", f"""
    WITH {_LOG} SELECT run_id, name, {sql_ts('min(started_at)')} AS start_time, {sql_ts('max(finished_at)')} AS end_time,
        round((epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1e6, 2) AS seconds
    FROM log WHERE step = 'load' AND name NOT IN ('_pipeline_state', 'Resources') GROUP BY run_id, name
""")
def metrics_load_duration(spark, sf_dir):
    return plain(observe.load_jobs(_log(spark, sf_dir)))


_STEPS = f"""{_LOG}, steps AS (
    SELECT run_id, step, CASE step WHEN 'extract' THEN 1 WHEN 'normalize' THEN 2 ELSE 3 END AS step_no, min(started_at) AS start_time,
        count(*) - count(finished_at) AS open, max(finished_at) AS last_end,
        arg_min(error, started_at) FILTER (WHERE error IS NOT NULL) AS error
    FROM log GROUP BY run_id, step)"""
_RUNS = f"""{_STEPS}, runs AS (
    SELECT run_id, CASE WHEN sum(open) > 0 THEN 'processing' WHEN count(error) > 0 THEN 'failed' ELSE 'completed' END AS status,
        min(start_time) AS start_time, max(last_end) AS last_end, string_agg(error, '; ' ORDER BY step_no) AS errors
    FROM steps GROUP BY run_id)"""


@query("metrics_status_rollup", f"""
    WITH {_RUNS} SELECT run_id, status, 'run' AS step FROM runs
    UNION ALL SELECT run_id, CASE WHEN open > 0 THEN 'processing' WHEN error IS NOT NULL THEN 'failed' ELSE 'completed' END, step FROM steps
""")
def metrics_status_rollup(spark, sf_dir):
    """The same rule for the run and for each of its steps."""
    log = _log(spark, sf_dir)
    runs = observe.run_status(log).select("run_id", "status", F.lit("run").alias("step"))
    return runs.unionByName(observe.step_summary(log).select("run_id", "status", "step"))


@query("metrics_error_join", f"WITH {_RUNS} SELECT run_id, errors AS error FROM runs WHERE status = 'failed'")
def metrics_error_join(spark, sf_dir):
    runs = observe.run_status(_log(spark, sf_dir))
    return runs.filter(F.col("status") == "failed").select("run_id", "error")


_COUNTERS = f"""{_LOG}, counters AS (
    SELECT run_id, step, name || coalesce('_' || label, '') AS counter, sum(inc)::BIGINT AS total,
        round((epoch_us(max(started_at)) - epoch_us(min(started_at))) / 1e6, 2) AS seconds
    FROM log WHERE name NOT IN ('_pipeline_state', 'Resources') GROUP BY ALL)"""


@query("metrics_rate", f"""
    WITH {_COUNTERS} SELECT run_id, step, counter, total, seconds,
        CASE WHEN seconds > 0 THEN round(total / seconds, 2) ELSE 0.0::DOUBLE END AS rate FROM counters
""")
def metrics_rate(spark, sf_dir):
    return observe.counter_rates(_log(spark, sf_dir)).drop("first_at", "last_at")


@query("metrics_counters", f"WITH {_COUNTERS} SELECT run_id, step, counter, total FROM counters")
def metrics_counters(spark, sf_dir):
    return observe.counters(_log(spark, sf_dir)).select("run_id", "step", "counter", "total")


@query("metrics_skip_system", f"WITH {_LOG} SELECT event_id, run_id, name FROM log WHERE name NOT IN ('_pipeline_state', 'Resources')")
def metrics_skip_system(spark, sf_dir):
    return observe.skip_system(_log(spark, sf_dir), "name", "label").select("event_id", "run_id", "name")


@query("metrics_step_progress", f"""
    WITH {_STEPS}, reached AS (SELECT run_id, max(step_no) AS furthest FROM steps GROUP BY run_id)
    SELECT run_id, step, CASE WHEN n < furthest OR (n = furthest AND n = 3) THEN 'completed' WHEN n = furthest THEN 'in-process'
        ELSE 'pending' END AS status
    FROM reached, (VALUES (1, 'extract'), (2, 'normalize'), (3, 'load')) AS s(n, step)
""")
def metrics_step_progress(spark, sf_dir):
    return observe.step_progress(_log(spark, sf_dir))


@query("metrics_latest", f"""
    WITH newest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC) = 1)
    SELECT c_custkey::VARCHAR AS identity, coalesce(event_type, '-') AS event_type, coalesce({sql_ts('ts')}, '-') AS at,
           CASE WHEN user_id IS NULL THEN 'Pipeline ''' || c_custkey || ''' not found' ELSE '' END AS message
    FROM customer LEFT JOIN newest ON user_id = c_custkey
""")
def metrics_latest(spark, sf_dir):
    """The newest entry of every customer's log; customers without one are not found."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("identity"), F.col("ts").alias("at"), "event_type")
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("identity"))
    rows = plain(observe.latest(log, asked))
    return rows.select("identity", F.coalesce("event_type", F.lit("-")).alias("event_type"), F.coalesce("at", F.lit("-")).alias("at"),
                       F.coalesce("message", F.lit("")).alias("message"))


@query("metrics_files", f"WITH {_LOG} SELECT DISTINCT run_id, label AS file FROM log WHERE name = 'Files'")
def metrics_files(spark, sf_dir):
    return observe.files_processed(_log(spark, sf_dir))


@query("metrics_observe", f"""
    WITH {_RUNS}, tables AS (
        SELECT run_id, step, count(DISTINCT name) AS tables, sum(row_count)::BIGINT AS row_count FROM log
        WHERE name NOT IN ('_pipeline_state', 'Resources') GROUP BY run_id, step)
    SELECT r.run_id, 'events' AS pipeline_name, 'file' AS source_type, 'dataset' AS destination_type, r.status,
        {sql_ts('r.start_time')} AS start_time, CASE WHEN r.status = 'processing' THEN '-' ELSE {sql_ts('r.last_end')} END AS end_time,
        CASE WHEN r.status = 'failed' THEN r.errors ELSE '-' END AS error, n.step,
        CASE WHEN s.run_id IS NULL THEN 'pending' WHEN s.open > 0 THEN 'processing' WHEN s.error IS NOT NULL THEN 'failed' ELSE 'completed' END AS step_status,
        coalesce(t.tables, 0)::INT AS tables, coalesce(t.row_count, 0)::BIGINT AS row_count
    FROM runs r CROSS JOIN (VALUES ('extract'), ('normalize'), ('load')) AS n(step)
    LEFT JOIN steps s ON s.run_id = r.run_id AND s.step = n.step LEFT JOIN tables t ON t.run_id = r.run_id AND t.step = n.step
""")
def metrics_observe(spark, sf_dir):
    """The whole result, with its per-step map opened for comparison."""
    log = _log(spark, sf_dir)
    runs = observe.observe(log, log).select("*", F.explode("metrics").alias("step", "m"))
    tables = F.coalesce("m.resource_metrics", F.array().cast(runs.schema["m"].dataType["resource_metrics"].dataType))
    rows = F.aggregate(tables, F.lit(0).cast("long"), lambda acc, t: acc + t["row_count"])
    return plain(runs).select(
        "run_id", "pipeline_name", "source_type", "destination_type", "status", "start_time", F.coalesce("end_time", F.lit("-")).alias("end_time"),
        F.coalesce("error", F.lit("-")).alias("error"), "step", F.col("m.status").alias("step_status"), F.size(tables).alias("tables"),
        rows.alias("row_count"))
