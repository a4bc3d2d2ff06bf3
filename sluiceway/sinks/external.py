"""Destinations other than the parquet dataset: format and options per scheme.

Each needs its driver or connector package on Spark's classpath.
"""

from __future__ import annotations

from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.uri import SCHEMES
from sluiceway.sources.jdbc import DRIVERS, jdbc_options, read_table, write_table

DESTINATIONS = {name for name, _, _, is_destination, _ in SCHEMES if is_destination}
DEFAULT_DATASET = {name: dataset for name, *_, dataset in SCHEMES}


def destination(uri: str) -> tuple[str, dict[str, str]]:
    """(kind, options): `dataset` for folders, `jdbc`, or a connector's format name."""
    parts = urlsplit(uri)
    scheme = parts.scheme.lower()
    if scheme not in DESTINATIONS:
        raise ValueError(f"Invalid destination URI scheme: {scheme}")
    params = {k: v[0] for k, v in parse_qs(parts.query).items()}
    if scheme == "file":
        return "dataset", {"path": f"file://{parts.path}"}
    if scheme == "s3":
        return "dataset", {"path": f"s3a://{parts.netloc}{parts.path}".rstrip("/")}
    if scheme == "athena":
        return "dataset", {"path": f"s3a://{parts.netloc}{parts.path}".rstrip("/"), "work_group": params.get("work_group", "")}
    if scheme == "bigquery":
        return "bigquery", {"parentProject": parts.netloc, "project": parts.netloc}
    if scheme == "databricks":
        return "table", {}
    if scheme in DRIVERS:
        return "jdbc", jdbc_options(uri)
    raise ValueError(f"Invalid destination URI scheme: {scheme}")


def qualified(dataset: str | None, table: str) -> str:
    return f"{dataset}.{table}" if dataset else table


def write_external(df: DataFrame, uri: str, dataset: str | None, table: str, mode: str) -> None:
    """Append to, replace or (`errorifexists`) create a table at an external destination."""
    kind, options = destination(uri)
    name = qualified(dataset, table)
    if kind == "jdbc":
        write_table(df, uri, name, mode)
    elif kind == "table":
        df.write.mode(mode).saveAsTable(name)
    elif kind == "dataset":
        raise ValueError("folders are written through Dataset")
    else:
        df.write.format(kind).options(**options).option("table", name).mode(mode).save()


def read_external(spark: SparkSession, uri: str, dataset: str | None, table: str) -> DataFrame:
    """The current state of a JDBC destination table, for a merge computed in Spark."""
    return read_table(spark, uri, qualified(dataset, table))


def replace_staged(new_state: DataFrame, uri: str, dataset: str | None, table: str) -> None:
    """Write a merge result beside the table, then replace the table from that copy.

    The result may read the table itself, so it must be complete before the table
    is truncated.
    """
    staging = f"{table}__staging"
    write_external(new_state, uri, dataset, staging, "overwrite")
    write_external(read_external(new_state.sparkSession, uri, dataset, staging), uri, dataset, table, "overwrite")
