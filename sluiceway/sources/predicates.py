"""A source filter given as data: {column: value} or {column: {operator: value, …}}."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comparison operators of a filter.
OPERATORS: dict[str, Callable[[Column, object], Column]] = {
    "$eq": lambda c, v: c.isNull() if v is None else c == v,
    "$ne": lambda c, v: c.isNotNull() if v is None else c.isNull() | (c != v),
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: c.isNull() | ~c.isin(list(v)),
}


def operators_on(filter_: Mapping, column: str) -> list[str]:
    """The operators a filter uses on one column."""
    rule = filter_.get(column)
    if rule is None:
        return []
    return list(rule) if isinstance(rule, Mapping) else ["$eq"]


def predicate(filter_: Mapping) -> Column:
    """All conditions together, as one column the scan can take."""
    parts = []
    for name, rule in filter_.items():
        for operator, value in (rule.items() if isinstance(rule, Mapping) else [("$eq", rule)]):
            if operator not in OPERATORS:
                raise ValueError(f"unknown filter operator: {operator}")
            parts.append(OPERATORS[operator](F.col(f"`{name}`"), value))
    return reduce(Column.__and__, parts, F.lit(True))
