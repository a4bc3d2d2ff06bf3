"""From nested, loosely typed rows to flat relational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.names import snake_case

SEPARATOR = "__"
_CHUNK = 1_000_000
# An ISO date-time (a date alone stays text).
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


# ---- types and schema evolution -------------------------------------------------

# The widening order of numeric types.
_NUMERIC_ORDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both values fit in: numbers widen, anything simple fits text; else an error."""
    if a == b:
        return a
    if a.simpleString() == b.simpleString():  # they differ in what may be NULL inside
        return _nullable(a)
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    kinds = [type(a), type(b)]
    if all(k in _NUMERIC_ORDER for k in kinds):
        wide = max(kinds, key=_NUMERIC_ORDER.index)
        narrow = min(kinds, key=_NUMERIC_ORDER.index)
        return T.DoubleType() if wide is T.FloatType and narrow in (T.IntegerType, T.LongType) else wide()
    if {T.DateType, T.TimestampType} == set(kinds):
        return T.TimestampType()
    if {T.DateType, T.TimestampNTZType} == set(kinds):
        return T.TimestampNTZType()
    if T.StringType in kinds and all(isinstance(t, T.AtomicType) for t in (a, b)):
        return T.StringType()
    raise ValueError(f"no common type for {a.simpleString()} and {b.simpleString()}")


def _nullable(t: T.DataType) -> T.DataType:
    """The same type, with NULLs allowed in every part."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _nullable(t.valueType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t.fields])
    return t


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; new columns are added, absent ones are NULL, types widen."""
    have, got = old.schema, new.schema
    casts_old, casts_new = {}, {}
    for name in set(have.names) & set(got.names):
        wide = wider_type(have[name].dataType, got[name].dataType)
        if have[name].dataType != wide:
            casts_old[name] = F.col(f"`{name}`").cast(wide)
        if got[name].dataType != wide:
            casts_new[name] = F.col(f"`{name}`").cast(wide)
    left = old.withColumns(casts_old) if casts_old else old
    right = new.withColumns(casts_new) if casts_new else new
    return left.unionByName(right, allowMissingColumns=True)


def detect_iso_timestamps(df: DataFrame) -> DataFrame:
    """Turn text columns that hold only ISO date-times into timestamps.

    One aggregate over all text columns decides; only one row of booleans returns
    to the driver.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    checks = []
    for i, name in enumerate(texts):
        col = F.col(f"`{name}`")
        fits = col.rlike(ISO_DATETIME) & F.try_to_timestamp(col).isNotNull()
        checks.append(F.coalesce(F.bool_and(F.when(col.isNotNull(), fits)), F.lit(False)).alias(f"c{i}"))
    verdict = df.agg(*checks).first()
    found = [name for name, ok in zip(texts, verdict) if ok]
    return df.withColumns({n: F.try_to_timestamp(F.col(f"`{n}`")) for n in found}) if found else df


# ---- row and load identity ------------------------------------------------------


def with_load_id(df: DataFrame, load_id: str) -> DataFrame:
    return df.withColumn("_load_id", F.lit(load_id))


def with_row_id(df: DataFrame, load_id: str = "", keys: Sequence[str] = ()) -> DataFrame:
    """A deterministic unique `_row_id`.

    With unique keys it is the hash of their values (and of the load id, if given: leave it
    out for ids that stay the same from load to load) and needs no shuffle. Without, identical
    rows are told apart by an ordinal: they are counted (map-side combine) and
    written out again from the count, so no task ever sorts or numbers one huge
    group; counts above a million are spread over tasks in slices.
    """
    names = df.columns
    if keys:
        return df.withColumn("_row_id", _id_of([F.col(f"`{k}`") for k in keys], load_id, F.lit(0)))
    counted = df.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("__n"))
    few = counted.filter(F.col("__n") <= _CHUNK)
    few = few.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    many = counted.filter(F.col("__n") > _CHUNK)
    many = many.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(_CHUNK).cast("long"))))
    many = many.repartition(F.col("__from"), *[F.col(f"`{c}`") for c in names])
    last = F.least(F.col("__from") + _CHUNK, F.col("__n")) - 1
    many = many.withColumn("__i", F.explode(F.sequence(F.col("__from"), last))).drop("__from")
    numbered = few.unionByName(many)
    row_id = _id_of([F.col(f"`{c}`") for c in names], load_id, F.col("__i"))
    return numbered.withColumn("_row_id", row_id).select(*[F.col(f"`{c}`") for c in names], "_row_id")


def _id_of(cols: Sequence[Column], load_id: str, ordinal: Column) -> Column:
    content = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return F.sha2(F.concat_ws("|", content, F.lit(load_id), ordinal.cast("string")), 256)


# ---- nested data ----------------------------------------------------------------


def _leaves(prefix: Column | None, fields: Sequence[T.StructField], path: str) -> list[tuple[str, Column, T.DataType]]:
    out = []
    for f in fields:
        col = F.col(f"`{f.name}`") if prefix is None else prefix.getField(f.name)
        # system columns keep their leading underscore as they are
        name = f.name if prefix is None and f.name.startswith("_") else path + snake_case(f.name)
        if isinstance(f.dataType, T.StructType):
            out += _leaves(col, f.dataType.fields, name + SEPARATOR)
        else:
            out.append((name, col, f.dataType))
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects become columns `a__b`; arrays and maps stay."""
    leaves = _leaves(None, df.schema.fields, "")
    names = [n for n, _, _ in leaves]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names collide after flattening: {', '.join(clash)}")
    return df.select(*[c.alias(n) for n, c, _ in leaves])


def relational(df: DataFrame, table: str, row_id: str = "_row_id") -> dict[str, DataFrame]:
    """The root table and one child table per array or map, to any depth.

    Child rows carry their parent's and root's row id and their list position.
    Everything is a narrow projection or generator; nothing is shuffled.
    """
    if row_id not in df.columns:
        raise ValueError(f"the root rows need their id in {row_id}")
    root = df if row_id == "_row_id" else df.withColumnRenamed(row_id, "_row_id")
    out: dict[str, DataFrame] = {}
    _split(flatten(root), table, F.col("_row_id"), out)
    return out


def _split(flat: DataFrame, table: str, root_id: Column, out: dict[str, DataFrame]) -> None:
    nested = [f for f in flat.schema if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    out[table] = flat.drop(*[f.name for f in nested])
    for f in nested:
        name = f"{table}{SEPARATOR}{f.name}"
        items = F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        rows = flat.select(
            F.col("_row_id").alias("_parent_id"), root_id.alias("_root_id"), F.posexplode(items).alias("_list_idx", "value")
        )
        rows = rows.withColumn(
            "_row_id", F.sha2(F.concat_ws("|", "_parent_id", F.lit(name), F.col("_list_idx").cast("string")), 256)
        )
        element = rows.schema["value"].dataType
        if isinstance(element, T.StructType):
            system = ["_row_id", "_parent_id", "_root_id", "_list_idx"]
            rows = rows.select(*[c.alias(n) for n, c, _ in _leaves(F.col("value"), element.fields, "")], *system)
        _split(rows, name, F.col("_root_id"), out)
