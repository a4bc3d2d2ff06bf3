"""Run metrics as aggregations over ordinary tables.

`steps`: run_id, pipeline_name, source_type, destination_type, step, started_at,
finished_at, error; several rows per step are allowed.
`resources`: run_id, step, name, row_count, file_size, started_at, finished_at.
`updates`: run_id, step, name, label, inc, at.
All of them are reduced per (run, step) with a map-side combine before anything is
gathered per run, so a run that holds most of the log does not fill one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The steps of a run in order, and names that are not user tables.
STEPS = ("extract", "normalize", "load")
STATE_TABLE = "_pipeline_state"
SYSTEM_NAMES = (STATE_TABLE, "Resources")


def step_number(step: Column) -> Column:
    number = F.lit(None).cast("int")
    for i, name in enumerate(STEPS):
        number = F.when(step == name, F.lit(i + 1)).otherwise(number)
    return number


def skip_system(df: DataFrame, name: str = "name", label: str | None = None) -> DataFrame:
    """Leave out the state table and the resource counter, by their whole names; with `label`, also what is labelled with the state table."""
    keep = ~F.col(name).isin(*SYSTEM_NAMES)
    if label:
        keep = keep & ~F.coalesce(F.col(label) == STATE_TABLE, F.lit(False))
    return df.filter(keep)


def rows_per_table(resources: DataFrame, step: str) -> DataFrame:
    """Rows and bytes per run and table of one step."""
    mine = skip_system(resources.filter(F.col("step") == step))
    return mine.groupBy("run_id", "name").agg(
        F.sum("row_count").alias("row_count"), F.sum("file_size").alias("file_size")
    )


def load_jobs(resources: DataFrame) -> DataFrame:
    """Per run and table: start, end and seconds of the load step."""
    mine = skip_system(resources.filter(F.col("step") == "load"))
    spans = mine.groupBy("run_id", "name").agg(F.min("started_at").alias("start_time"), F.max("finished_at").alias("end_time"))
    return spans.withColumn("seconds", elapsed(F.col("start_time"), F.col("end_time")))


def elapsed(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros / F.lit(1e6), 2)


def rate(count: Column, seconds: Column) -> Column:
    """Items per second with two decimals; 0 when no time passed."""
    return F.when(seconds > 0, F.round(count / seconds, 2)).otherwise(F.lit(0.0))


def step_summary(steps: DataFrame, about: tuple[str, ...] = ()) -> DataFrame:
    """One row per run and step: span, first error, status, and facts about the run if named."""
    known = steps.filter(F.col("step").isin(*STEPS))
    span = known.groupBy("run_id", "step").agg(
        F.min("started_at").alias("start_time"),
        F.max("finished_at").alias("last_end"),
        F.count_if(F.col("finished_at").isNull()).alias("open"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.struct("started_at", "error"))).alias("error"),
        *[F.any_value(c, True).alias(c) for c in about],
    )
    status = F.when(F.col("open") > 0, "processing").when(F.col("error").isNotNull(), "failed").otherwise("completed")
    end = F.when(F.col("open") == 0, F.col("last_end"))
    return span.select("run_id", "step", step_number(F.col("step")).alias("step_no"), "start_time",
                       end.alias("end_time"), status.alias("status"), "error", *about)


def _run_aggregates() -> list[Column]:
    """What a run's status needs from its (at most three) step rows; errors joined in step order."""
    per_step = [F.max(F.when(F.col("step") == s, F.col("error"))) for s in STEPS]
    return [
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("__end"),
        F.count_if(F.col("status") == "processing").alias("__open"),
        F.count_if(F.col("error").isNotNull()).alias("__bad"),
        F.concat_ws("; ", *per_step).alias("__error"),
    ]


def _run_columns() -> list[Column]:
    """processing while any step is open, failed after an error, else completed."""
    open_, bad = F.col("__open") > 0, F.col("__bad") > 0
    return [
        F.col("start_time"), F.when(~open_, F.col("__end")).alias("end_time"),
        F.when(open_, "processing").when(bad, "failed").otherwise("completed").alias("status"),
        F.when(~open_ & bad, F.col("__error")).alias("error"),
    ]


def run_status(steps: DataFrame) -> DataFrame:
    """Span, status and joined errors of each run."""
    return step_summary(steps).groupBy("run_id").agg(*_run_aggregates()).select("run_id", *_run_columns())


def counters(updates: DataFrame) -> DataFrame:
    """Sum of increments per run, step and counter; a label makes a counter of its own."""
    named = F.when(F.coalesce(F.col("label"), F.lit("")) != "", F.concat_ws("_", "name", "label")).otherwise(F.col("name"))
    rows = skip_system(updates, "name", "label").withColumn("counter", named)
    return rows.groupBy("run_id", "step", "counter").agg(
        F.sum("inc").alias("total"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )


def counter_rates(updates: DataFrame) -> DataFrame:
    """Each counter with its elapsed seconds and rate."""
    seconds = elapsed(F.col("first_at"), F.col("last_at"))
    return counters(updates).withColumn("seconds", seconds).withColumn("rate", rate(F.col("total"), F.col("seconds")))


def step_progress(updates: DataFrame) -> DataFrame:
    """Status of every step of a run from the furthest step seen.

    Earlier steps are completed, the furthest is in process, later ones pending; a
    run that reached its load has completed it as well.
    """
    reached = updates.groupBy("run_id").agg(F.max(step_number(F.col("step"))).alias("__max"))
    each = reached.select("run_id", "__max", F.posexplode(F.array(*[F.lit(s) for s in STEPS])).alias("__pos", "step"))
    number = F.col("__pos") + 1
    status = (
        F.when(number < F.col("__max"), "completed")
        .when(number > F.col("__max"), "pending")
        .when(number == len(STEPS), "completed")
        .otherwise("in-process")
    )
    return each.select("run_id", "step", status.alias("status"))


def latest(log: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """The newest entry of each identity; an asked identity without entries is `not found`."""
    payload = [c for c in log.columns if c not in ("identity", "at")]
    newest = log.groupBy("identity").agg(F.max_by(F.struct(*payload), "at").alias("r"), F.max("at").alias("at"))
    newest = newest.select("identity", "at", *[F.col(f"r.`{c}`").alias(c) for c in payload], F.lit(True).alias("__hit"))
    if asked is not None:
        newest = asked.select("identity").distinct().join(newest, "identity", "left")
    missing = F.when(F.col("__hit").isNull(), F.concat(F.lit("Pipeline '"), F.col("identity"), F.lit("' not found")))
    return newest.withColumn("message", missing).drop("__hit")


def files_processed(updates: DataFrame) -> DataFrame:
    """The distinct files of each run as rows, so a run with very many files is no single huge value."""
    mine = updates.filter((F.col("step") == "normalize") & (F.col("name") == "Files") & F.col("label").isNotNull())
    return skip_system(mine, "name", "label").select("run_id", F.col("label").alias("file")).distinct()


def observe(steps: DataFrame, resources: DataFrame) -> DataFrame:
    """One row per run: identity, types, span, status, error and the metrics of every step.

    The per-run map has one entry per step, and a step's list one entry per table
    of the job, both after aggregation.
    """
    about = ("pipeline_name", "source_type", "destination_type")
    tables = skip_system(resources).groupBy("run_id", "step", "name").agg(
        F.sum("row_count").alias("row_count"), F.sum("file_size").alias("file_size"),
        F.min("started_at").alias("start_time"), F.max("finished_at").alias("end_time"),
    )
    lists = tables.groupBy("run_id", "step").agg(
        F.sort_array(F.collect_list(F.struct("name", "row_count", "file_size", "start_time", "end_time"))).alias("resource_metrics")
    )
    per_step = step_summary(steps, about).join(lists, ["run_id", "step"], "left")
    entry = F.struct("start_time", "end_time", "status", "error", "resource_metrics")
    runs = per_step.groupBy("run_id").agg(
        *_run_aggregates(), *[F.any_value(c, True).alias(c) for c in about],
        *[F.any_value(F.when(F.col("step") == s, entry), True).alias(f"__{s}") for s in STEPS],
    )
    shape = runs.schema["__load"].dataType.simpleString()
    pending = F.expr(f"cast(named_struct('start_time', null, 'end_time', null, 'status', 'pending', 'error', null, "
                     f"'resource_metrics', null) as {shape})")
    metrics = F.create_map(*[x for s in STEPS for x in (F.lit(s), F.coalesce(F.col(f"__{s}"), pending))])
    return runs.select("run_id", *about, *_run_columns(), metrics.alias("metrics"))
