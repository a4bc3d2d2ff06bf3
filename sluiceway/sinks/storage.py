"""Small-file access on whatever file system Spark is configured for."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def sub_folders(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(path) or []))


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a folder; names that begin with a dot or an underscore are Spark's own."""
    fs, path = _path(spark, folder)
    found = (s.getPath() for s in (fs.listStatus(path) if fs.exists(path) else []) if s.isFile())
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")


def set_time(spark: SparkSession, name: str, epoch_ms: int) -> None:
    """Give a file a modification time."""
    fs, path = _path(spark, name)
    fs.setTimes(path, epoch_ms, -1)


def size_of(spark: SparkSession, folders: list[str]) -> int:
    total = 0
    for folder in folders:
        fs, path = _path(spark, folder)
        total += fs.getContentSummary(path).getLength()
    return total


def remove(spark: SparkSession, folder: str) -> None:
    fs, path = _path(spark, folder)
    fs.delete(path, True)


def read_json(spark: SparkSession, name: str) -> dict:
    fs, path = _path(spark, name)
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json_once(spark: SparkSession, name: str, content: dict) -> None:
    """Publish a small document under a name that must be new, complete or not at all."""
    fs, final = _path(spark, name)
    temp = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(json.dumps(content).encode("utf-8")))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(temp, final):
        fs.delete(temp, False)
        raise FileExistsError(f"{name} was committed by another writer")


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of job or run facts as a local relation, without a Python worker."""
    fields = T.StructType.fromDDL(schema)
    records = [dict(zip(fields.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(fields)), fields)
