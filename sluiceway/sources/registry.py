"""From a source URI and table name to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.uri import SCHEMES
from sluiceway.sources import documents, files, jdbc, rejects, topics

FAMILY = {name: family for name, family, *_ in SCHEMES}
SOURCES = {name for name, _, is_source, *_ in SCHEMES if is_source}


def folder_of(uri: str) -> str:
    """The folder a file URI names, in the file-system scheme Spark uses. Credentials are Spark settings."""
    parts = urlsplit(uri)
    scheme = parts.scheme.lower()
    if scheme == "file":
        return f"file://{parts.path}"
    base = f"{files.FILE_SYSTEMS[scheme]}://{parts.netloc}"
    if scheme == "az":
        account = parse_qs(parts.query).get("account_name", [""])[0]
        base = f"abfss://{parts.netloc}@{account}.dfs.core.windows.net"
    return base + parts.path.rstrip("/")


def _read_files(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame:
    """Files by prefix; with a `payload` they are archived messages, read from `start_from` on."""
    folder, schema, after = folder_of(uri), options.get("schema"), options.get("modified_after")
    if options.get("payload"):
        envelope = files.read_files(spark, folder, name, schema, after)
        kind, millis = topics.parse_start(options.get("start_from") or "earliest")
        if kind == "latest":
            raise ValueError("a bounded read from 'latest' is empty; use `resume`")
        return decoded(topics.spread(topics.from_timestamp(envelope, millis) if kind == "timestamp" else envelope), options)
    if options.get("with_rejects"):
        return rejects.read_checked(spark, folder, name, schema, after)
    return files.read_files(spark, folder, name, schema, after)


def _read_sql(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame:
    return jdbc.read_table(spark, uri, name, options.get("split_column"), options.get("bounds"), options.get("splits", 1))


def _read_documents(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame:
    """Through the Mongo Spark connector, when its package is present."""
    parts = urlsplit(uri)
    database = parse_qs(parts.query).get("database", [None])[0]
    if not database:
        raise ValueError("the MongoDB URI names no database")
    address = f"mongodb://{parts.netloc}{parts.path}"
    reader = spark.read.format("mongodb").option("connection.uri", address)
    df = reader.option("database", database).option("collection", name).load()
    return documents.convert_extended_json(df)


def _read_topic(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame:
    return decoded(topics.read_topic(spark, uri, name, options.get("start_from") or "earliest"), options)


def decoded(envelope: DataFrame, options: Mapping) -> DataFrame:
    """Messages with the fields of the declared payload; without one they stay as they are."""
    if not options.get("payload"):
        return envelope
    rest = "undeclared_fields"  # as JSON text, which every merge can compare
    rows = topics.decode(envelope, options["payload"], rest=rest, keep_mistyped=True, mark=rejects.MARKS if options.get("with_rejects") else ())
    return rows.withColumn(rest, F.to_json(rest))


def open_stream(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame:
    """The same source as a stream of files or undecoded messages; `batch_size` bounds a batch (in messages, or files)."""
    scheme, size = urlsplit(uri).scheme.lower(), options.get("batch_size")
    family = FAMILY.get(scheme)
    if family == "kafka":
        return topics.stream_topic(spark, uri, name, options.get("start_from") or "earliest", size or topics.BATCH_SIZE)
    if READERS.get(family) is not _read_files:
        raise ValueError(f"{scheme} sources cannot be resumed as a stream; use incremental_config")
    at_once = {"maxFilesPerTrigger": str(size)} if size else {}
    rows = rejects.read_checked(spark, folder_of(uri), name, options.get("schema"), stream=True, **at_once)
    return topics.spread(rows) if options.get("payload") else rows


def archived(spark: SparkSession, uri: str, name: str, options: Mapping) -> DataFrame | None:
    """Start offsets of a stream over archived messages; None for any other source, or from the beginning."""
    if not options.get("payload") or FAMILY[urlsplit(uri).scheme.lower()] == "kafka":
        return None
    return topics.start_offsets(files.read_files(spark, folder_of(uri), name, options.get("schema")), options.get("start_from") or "earliest")


READERS: dict[str, Callable[[SparkSession, str, str, Mapping], DataFrame]] = {
    "s3": _read_files, "gcs": _read_files, "azure": _read_files, "file": _read_files,
    "sql": _read_sql, "filebased": _read_sql, "snowflake": _read_sql,
    "mongodb": _read_documents, "kafka": _read_topic,
}


def open_source(spark: SparkSession, uri: str, name: str, options: Mapping | None = None) -> DataFrame:
    """The rows of one table, file prefix, collection or topic."""
    scheme = urlsplit(uri).scheme.lower()
    if scheme not in SOURCES:
        raise ValueError(f"Invalid source URI scheme: {scheme}")
    return READERS[FAMILY[scheme]](spark, uri, name, options or {})
