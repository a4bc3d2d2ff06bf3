"""Rows that cannot be loaded, marked by their reader so that one pass can write them apart.

A checked reader adds two columns: why a row is rejected (NULL for a good row) and its text.
The runner writes good rows and rejected rows in one pass and publishes both by one commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.sources import files

#: Why a row is rejected, the row as it was read, and the file it is from.
REASON, VALUE, FILE = "_reject_reason", "_reject_value", "_reject_file"
MARKS = (REASON, VALUE, FILE)
#: Columns of the table that keeps rejected rows.
SCHEMA = "resource string, reason string, value string, file string, _load_id string"

_CORRUPT = "_corrupt_record"


def is_marked(df: DataFrame) -> bool:
    return REASON in df.columns


def rejected() -> Column:
    return F.col(REASON).isNotNull()


def read_checked(
    spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None, modified_after=None, stream: bool = False, **options: str
) -> DataFrame:
    """As `read_files`, with the marks for CSV and JSON lines; parquet rows have a type already and no marks.

    Malformed are JSON lines that do not parse or are no object, CSV lines with another number of
    fields than the header, and values that are not of the declared (or inferred) type.
    """
    fmt = files.format_of(name)
    if fmt == "parquet":
        schema = schema or (files.read_files(spark, base, name).schema if stream else None)
        return files.read_files(spark, base, name, schema, modified_after, stream, **options)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if declared is None:  # inferred from the same files, as `read_files` does
        inferred = files.read_files(spark, base, name, None, modified_after).schema
        declared = T.StructType([f for f in inferred.fields if f.name != _CORRUPT])
    taken = sorted({*MARKS, _CORRUPT}.intersection(declared.names))
    if taken:
        raise ValueError(f"source columns {', '.join(taken)} have names that the load needs")
    marked = T.StructType([*declared.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**options, "columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}
    if fmt == "csv" and schema is None:
        options["enforceSchema"] = "false"  # headers are compared with the inferred names
    df = files.read_files(spark, base, name, marked, modified_after, stream, **options)
    text = F.col(_CORRUPT)
    return df.withColumns({REASON: F.when(text.isNotNull(), _why(fmt, text, declared)), VALUE: text, FILE: F.col("_metadata.file_path")}).drop(_CORRUPT)


def _why(fmt: str, text: Column, declared: T.StructType) -> Column:
    if fmt == "json":
        parsed = F.try_parse_json(text)
        return (
            F.when(parsed.isNull(), "malformed")
            .when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not an object")
            .otherwise("a value is not of the declared type")
        )
    return F.when(_csv_fields(text) != len(declared), "another number of fields").otherwise("a value is not of the declared type")


def _csv_fields(text: Column) -> Column:
    """Fields of a CSV line: quoted parts, which may hold commas, are taken out first."""
    return F.size(F.split(F.regexp_replace(text, r'"(?:[^"\\\\]|\\\\.|"")*"', "q"), ",", -1))


def apart(df: DataFrame, keep_text: bool) -> tuple[DataFrame, DataFrame]:
    """(good rows without marks, rejected rows as reason, value, file). Texts are left out unless `keep_text`."""
    good = df.filter(~rejected()).drop(*MARKS)
    value = F.col(VALUE) if keep_text else F.lit(None).cast("string")
    return good, df.filter(rejected()).select(F.col(REASON).alias("reason"), value.alias("value"), F.col(FILE).alias("file"))
