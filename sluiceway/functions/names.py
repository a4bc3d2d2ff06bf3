"""Column and table names in lower snake_case."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    """`ResidenceType`, `residence type` and `residence-type` all read `residence_type`."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name.strip()))
    words = re.sub(r"[^0-9A-Za-z_]+", "_", spaced).lower().rstrip("_") or "_"
    return f"_{words}" if words[0].isdigit() else words


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column; two names that become one are an error."""
    names = [snake_case(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names collide after normalisation: {', '.join(clash)}")
    return df.toDF(*names)
