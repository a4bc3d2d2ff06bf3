"""Shared helpers: reading tables, mapping texts in Arrow batches, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Texts turned into Python objects at once; bounds a worker's memory, not the rows.
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20

#: ASCII white space, the only characters that separate words: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"

Texts = list[str | None]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once for each Spark application."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="sluiceway-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow whose function may use this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch of at most SLICE_ROWS rows, cut earlier when their texts are long."""
    start, n = 0, batch.num_rows
    while start < n:
        part = batch.slice(start, min(SLICE_ROWS, n - start))
        while part.num_rows > 1 and part.column(text).nbytes > SLICE_BYTES:
            part = part.slice(0, part.num_rows // 2)
        yield part, part.column(text).to_pylist()
        start += part.num_rows


def map_texts(df: DataFrame, key: str, text: str, make: Callable[[], Callable[[Texts], dict[str, Sequence[Any]]]], schema: str) -> DataFrame:
    """Apply a function of texts to every row; returns the key and the columns of `schema`.

    `make` is called once a task and returns the function, which gets texts and gives one list for each
    column. The key keeps its type and never becomes a Python object. Rows keep their number and order.
    """
    kind = df.schema[key].dataType.simpleString()
    names = [part.split()[0] for part in schema.split(",")]
    types = [_arrow_type(part.split()[1]) for part in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in slices(batch, 1):
                got = work(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[n], type=t) for n, t in zip(names, types, strict=True))], names=["_key", *names])

    picked = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    return map_arrow(picked, run, f"_key {kind}, {schema}").withColumnRenamed("_key", key)


def _arrow_type(name: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[name]


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local master without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = os.environ.get("SLUICEWAY_LOCAL_SCRATCH") or tempfile.mkdtemp(prefix="sluiceway-")
    os.environ["SLUICEWAY_LOCAL_SCRATCH"] = folder
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that a lost executor costs no earlier stage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def cut_estimates(df: DataFrame) -> DataFrame:
    """As cut, and without the estimated size and the constraints that a checkpoint inherits from its plan.

    A join's estimate is the product of its sides, so in a loop of joins the inherited numbers double their
    digits in each round, until the driver spends its time and memory on them alone.
    """
    written, spark = cut(df)._jdf, df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(written.queryExecution().analyzed().rdd(), written.schema(), False), spark)


def as_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8: bytes.split() parts at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
