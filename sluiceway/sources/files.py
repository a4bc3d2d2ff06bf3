"""Files by name prefix: CSV, JSON lines and parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.rules import split_rejects

# File extension -> Spark format.
FORMATS = {".csv": "csv", ".jsonl": "json", ".parquet": "parquet"}
# URI scheme -> Hadoop file-system scheme.
FILE_SYSTEMS = {"s3": "s3a", "gs": "gs", "az": "abfss", "file": "file"}


class NoNewFiles(Exception):
    """No file is newer than the stored time, so there is nothing to read or infer a schema from."""


def format_of(name: str) -> str:
    lowered = name.lower()
    for extension, fmt in FORMATS.items():
        if lowered.endswith(extension):
            return fmt
    raise ValueError(f"Unsupported file format: {name!r} (expected one of {', '.join(FORMATS)})")


def read_files(
    spark: SparkSession,
    base: str,
    name: str,
    schema: T.StructType | str | None = None,
    modified_after: str | datetime | None = None,
    stream: bool = False,
    **options: str,
) -> DataFrame:
    """Every file whose name starts with `name`, read by the extension of `name`.

    Without a schema, CSV types are inferred by one more pass over the files; give
    the schema where that pass is too dear. `modified_after` keeps whole files by
    their modification time, decided when files are listed. A `stream` needs a schema; its
    checkpoint keeps the list of files that were read, whatever their times.
    """
    fmt = format_of(name)
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if stream:
        reader = reader.option("maxFileAge", "36500d")
    if fmt == "csv":
        reader = reader.option("header", "true")
        reader = reader.option("enforceSchema", "false") if schema is None else reader
        reader = reader if schema is not None else reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", str(modified_after).replace(" ", "T"))
    try:
        return reader.load(f"{base.rstrip('/')}/{name}*")
    except AnalysisException as failure:
        if modified_after is not None and failure.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise NoNewFiles(f"no file {name}* is newer than {modified_after}") from failure
        raise


def read_json_lines(spark: SparkSession, base: str, name: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with their text and reason) of JSON-lines files of a declared schema."""
    lines = spark.read.text(f"{base.rstrip('/')}/{name}*")
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.withColumn("_row", parsed)
    reason = F.when(F.col("_row").isNull() | F.col("_row._corrupt").isNotNull(), "malformed")
    good, bad = split_rejects(rows, reason)
    return good.select("_row.*").drop("_corrupt"), bad.drop("_row")


def modified_at() -> Column:
    """Modification time of the file a row came from; its maximum is the next file cursor."""
    return F.col("_metadata.file_modification_time")


def dated_files(
    spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None, modified_after=None
) -> DataFrame:
    """As `read_files`, with the modification time as column `_modified_at`."""
    df = read_files(spark, base, name, schema, modified_after)
    return df.select("*", modified_at().alias("_modified_at"))
