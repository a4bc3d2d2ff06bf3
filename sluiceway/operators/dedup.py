"""One row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.keys import key_list, sortable


def dedup(df: DataFrame, keys: str | Sequence[str], sort: Mapping[str, str] | None = None) -> DataFrame:
    """Keep the first row of each key after sorting by `sort` ({column: asc|desc}).

    NULLs sort last; all columns follow as a tie-break, so the result does not
    depend on row order. The `= 1` filter becomes a group limit on the map side:
    each task sends at most one row per key, whatever the key's share of the data.
    """
    order = []
    for name, direction in (sort or {}).items():
        if direction not in ("asc", "desc"):
            raise ValueError(f"dedup sort direction must be 'asc' or 'desc', got {direction!r}")
        col = F.col(f"`{name}`")
        order.append(col.desc_nulls_last() if direction == "desc" else col.asc_nulls_last())
    keys = key_list(keys)
    order += [sortable(df, c).asc_nulls_last() for c in df.columns if c not in keys and c not in (sort or {})]
    first = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") == 1).drop("__rn")
