"""Loads, schema versions and incremental state of a dataset, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.sinks.dataset import Dataset

METRICS_SCHEMA = (
    "run_id string, pipeline_name string, source_type string, destination_type string, step string, name string, "
    "row_count long, file_size long, started_at timestamp_ntz, finished_at timestamp_ntz, error string"
)
_COMMIT = (
    "version long, load_id string, pipeline string, status int, committed_at string, "
    "tables array<struct<name string, schema string, schema_hash string, schema_version long, "
    "previous_hashes array<string>, rows_written long, bytes_written long, changed boolean>>, "
    "state array<struct<resource string, cursor string, cursor_type string>>, "
    "streams array<struct<name string, checkpoint_id string, batch_id long>>"
)


def _commits(dataset: Dataset) -> DataFrame:
    return dataset.spark.read.schema(_COMMIT).json(f"{dataset.base}/_commits/*.json")


def loads(dataset: Dataset) -> DataFrame:
    """One row per completed load and table it changed."""
    rows = _commits(dataset).filter(F.col("load_id") != "").withColumn("t", F.explode(F.filter("tables", lambda t: t["changed"])))
    return rows.select(
        "load_id", F.col("pipeline").alias("schema_name"), "status", F.to_timestamp_ntz("committed_at").alias("inserted_at"),
        F.col("t.name").alias("table_name"), F.col("t.schema_hash").alias("schema_version_hash"), "t.rows_written",
        "t.bytes_written",
    )


def schema_versions(dataset: Dataset) -> DataFrame:
    """Every schema version a table has had, first seen in which load."""
    rows = _commits(dataset).withColumn("t", F.explode("tables"))
    first = rows.groupBy(F.col("t.name").alias("table_name"), F.col("t.schema_version").alias("schema_version")).agg(
        F.min_by(F.struct("load_id", "committed_at", "t"), "version").alias("r")
    )
    return first.select(
        "table_name", "schema_version", F.col("r.t.schema_hash").alias("version_hash"),
        F.col("r.t.previous_hashes").alias("previous_hashes"), F.col("r.t.schema").alias("schema"),
        F.col("r.load_id").alias("load_id"), F.to_timestamp_ntz(F.col("r.committed_at")).alias("inserted_at"),
    )


def pipeline_state(dataset: Dataset) -> DataFrame:
    """The newest stored cursor of every resource."""
    rows = _commits(dataset).withColumn("s", F.explode("state"))
    newest = rows.groupBy(F.col("s.resource").alias("resource")).agg(F.max_by("s", "version").alias("s"), F.max("version").alias("version"))
    return newest.select("resource", F.col("s.cursor").alias("cursor"), F.col("s.cursor_type").alias("cursor_type"), "version")


def stored_cursor(dataset: Dataset, resource: str) -> str | None:
    """The one value a run needs on the driver."""
    found = [s for s in dataset.latest()["state"] if s["resource"] == resource]
    return found[0]["cursor"] if found else None


def job_result(dataset: Dataset) -> DataFrame:
    """Status, message, pipeline and schema hash of the newest load of each pipeline."""
    newest = _commits(dataset).filter(F.col("load_id") != "").groupBy("pipeline").agg(
        F.max_by(F.struct("load_id", "status", "tables"), "version").alias("r")
    )
    hashes = F.array_sort(F.transform("r.tables", lambda t: F.concat_ws(":", t["name"], t["schema_hash"])))
    return newest.select(
        F.when(F.col("r.status") == 0, "success").otherwise("error").alias("status"),
        F.when(F.col("r.status") == 0, F.lit("Data ingestion completed")).otherwise(F.lit("Data ingestion failed")).alias("message"),
        F.col("pipeline").alias("pipeline_name"), F.col("r.load_id").alias("load_id"),
        F.sha2(F.concat_ws(",", hashes), 256).alias("schema_version_hash"),
    )


def run_metrics(dataset: Dataset) -> DataFrame:
    """One row per run, step and table; the input of the functions in `operators.observe`."""
    return dataset.spark.read.schema(METRICS_SCHEMA).parquet(f"{dataset.base}/_run_metrics/*")
