"""Document collections from extended-JSON exports."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.sinks.storage import sub_folders

# The wrapper fields of extended JSON.
WRAPPERS = (
    "$oid", "$numberDecimal", "$numberLong", "$numberInt", "$numberDouble", "$date", "$timestamp", "$regularExpression",
    "$regex", "$binary", "$code", "$symbol",
)


def convert_extended_json(df: DataFrame) -> DataFrame:
    """Replace extended-JSON wrappers by plain values, at any depth, by a walk over the schema."""
    changed = {}
    for f in df.schema.fields:
        if _has_wrapper(f.dataType):
            changed[f.name] = _plain(F.col(f"`{f.name}`"), f.dataType)
    return df.withColumns(changed) if changed else df


def _has_wrapper(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_wrapper(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(f.name in WRAPPERS or _has_wrapper(f.dataType) for f in dtype.fields)
    return False


def _plain(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType) and _has_wrapper(dtype):
        return F.transform(col, lambda x: _plain(x, dtype.elementType))
    if not isinstance(dtype, T.StructType):
        return col
    fields = {f.name: f.dataType for f in dtype.fields}
    if set(fields) & set(WRAPPERS):
        return _unwrapped(col, fields)
    inner = [_plain(col.getField(n), t).alias(n) for n, t in fields.items()]
    return F.when(col.isNotNull(), F.struct(*inner))


def _unwrapped(col: Column, fields: dict[str, T.DataType]) -> Column:
    def get(name: str) -> Column:
        return col.getField(name)

    if "$date" in fields:
        dated = fields["$date"]
        if isinstance(dated, T.StructType):
            return F.timestamp_millis(F.try_to_number(get("$date").getField("$numberLong"), F.lit("S9999999999999999")).cast("long"))
        if isinstance(dated, T.IntegralType):
            return F.timestamp_millis(get("$date"))
        return F.try_to_timestamp(get("$date"))
    if "$timestamp" in fields:
        return F.timestamp_seconds(get("$timestamp").getField("t"))
    if "$numberLong" in fields:
        return get("$numberLong").try_cast("long")
    if "$numberInt" in fields:
        return get("$numberInt").try_cast("int")
    if "$numberDouble" in fields:
        return get("$numberDouble").try_cast("double")
    if "$regularExpression" in fields:
        return get("$regularExpression").getField("pattern")
    if "$binary" in fields:
        inner = get("$binary")
        return F.unbase64(inner.getField("base64") if isinstance(fields["$binary"], T.StructType) else inner)
    texts = [get(n).cast("string") for n in ("$oid", "$numberDecimal", "$regex", "$code", "$symbol") if n in fields]
    return F.coalesce(*texts)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    where: Column | None = None,
    order_by: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """One collection: read, convert, filter and, if asked, limit in the given order."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = convert_extended_json(reader.json(path))
    if where is not None:
        df = df.filter(where)
    return limited(df, order_by, limit)


def limited(df: DataFrame, order_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """The first `abs(limit)` rows in the given order; no limit when it is 0 or None."""
    if not limit:
        return df
    if not order_by:
        warnings.warn("a limit without an order returns arbitrary rows", stacklevel=2)
        return df.limit(abs(limit))
    return df.orderBy(*[F.col(f"`{c}`") for c in order_by]).limit(abs(limit))


def read_collections(
    spark: SparkSession, base: str, names: Sequence[str] | None = None, **options
) -> dict[str, DataFrame]:
    """The named collections, else every sub-folder of the export, one DataFrame each."""
    found = list(names) if names else [n for n in sub_folders(spark, base) if n[0] not in "._"]
    return {n: read_documents(spark, f"{base.rstrip('/')}/{n}", **options) for n in found}


def range_partitions(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Work split by key range, for a scan whose files do not split well."""
    return df.repartitionByRange(partitions, *[F.col(f"`{k}`") for k in keys])
