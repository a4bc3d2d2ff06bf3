"""Key sets and null-safe existence joins shared by every merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALTS = 16


def key_list(key: str | Sequence[str] | None) -> list[str]:
    """A key given as one name or several, as a list; None is the empty list."""
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def key_set(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key tuples of `rows`, as columns `__k0, __k1, …`, for semi and anti joins.

    A hot key collapses to one row per map task before anything is shuffled. The
    salt makes this aggregate's exchange different from the join's, so that both
    join inputs stay plain shuffle stages, which is what lets adaptive execution
    split a skewed partition of the other side or switch to a broadcast. A key
    occurs at most once per salt; add `distinct()` where each key must be single.
    """
    named = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    salted = rows.select(*named, (F.spark_partition_id() % _SALTS).alias("__salt"))
    return salted.distinct().drop("__salt")


def measured(found: DataFrame) -> DataFrame:
    """A key set, sent to every task if its measured size is within Spark's broadcast threshold.

    For key sets of written batches, which are cheap to read: the other side, the target, is then
    never shuffled. Left to adaptive execution, the target's shuffle is written before the small size is known.
    """
    limit = int(found.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = found.agg(F.sum(F.octet_length(F.to_json(F.struct(*found.columns))) + 32)).first()[0] or 0  # one number
    return F.broadcast(found) if size <= limit else found


def on_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality of `keys` with the columns of a `key_set`."""
    return reduce(Column.__and__, (F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))


def without_keys(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the key set."""
    return rows.join(found, on_keys(keys), "left_anti")


def with_keys(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the key set."""
    return rows.join(found, on_keys(keys), "left_semi")


def sortable(df: DataFrame, name: str) -> Column:
    """A column usable in ORDER BY: types without an order are compared as JSON text."""
    col = F.col(f"`{name}`")
    return F.to_json(F.struct(col)) if _unordered(df.schema[name].dataType) else col


def _unordered(dtype: T.DataType) -> bool:
    """Maps and variants have no order, nor has what holds one."""
    if isinstance(dtype, T.ArrayType):
        return _unordered(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_unordered(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def one_row_per_key(rows: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice.

    The keys alone are counted, with a map-side combine, so even a key held by a third of
    the rows reaches its reducer as one row per map task. The rows wait for the outcome, a
    scalar subquery in a filter, and are neither shuffled nor sorted for it.
    """
    message = F.concat(F.lit(f"{what}: more than one row for key ("), F.lit(", ".join(keys)), F.lit(") = "),
                       F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])))
    counted = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    failed = counted.agg(F.max(F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean"))))
    return rows.filter(failed.scalar().isNull())
