"""Column rules and the split of malformed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import pseudonym


def exclude(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; names the data does not have are ignored."""
    return df.drop(*columns)


def pseudonymize(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace the listed columns by salted hashes; missing columns are ignored."""
    if not salt:
        raise ValueError("pseudonymising needs a salt")
    present = {c: pseudonym(F.col(f"`{c}`"), df.schema[c].dataType, salt) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def apply_rules(
    df: DataFrame, exclude_columns: Sequence[str] = (), pseudonymizing_columns: Sequence[str] = (), salt: str = ""
) -> DataFrame:
    """Exclusion first, so a column named in both lists is dropped."""
    kept = exclude(df, exclude_columns)
    wanted = [c for c in pseudonymizing_columns if c not in exclude_columns]
    return pseudonymize(kept, wanted, salt) if wanted else kept


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows); `reason` is NULL for a good row and says why otherwise."""
    marked = df.withColumn("_reject_reason", reason)
    good = marked.filter(F.col("_reject_reason").isNull()).drop("_reject_reason")
    return good, marked.filter(F.col("_reject_reason").isNotNull())
