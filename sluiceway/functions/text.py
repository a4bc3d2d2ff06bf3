"""Text forms of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(col: Column, dtype: T.DataType) -> Column:
    """The text of a value that is hashed: plain cast, except booleans and timestamps.

    Booleans read `True`/`False`; timestamps show six fraction digits only when the
    fraction is not zero. Doubles keep Spark's own text.
    """
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        exact = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(exact.endswith(".000000"), whole).otherwise(exact)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def pseudonym(col: Column, dtype: T.DataType, salt: str) -> Column:
    """Hex SHA-256 of the value's text followed by the salt; NULL stays NULL."""
    return F.sha2(F.concat(canonical_text(col, dtype), F.lit(salt)), 256)
