"""Merge dispositions: (target, incoming, keys) -> the target's new state.

Every function is one lazy plan. Target rows are removed by anti-joins on narrow
key sets. With `measure`, for incoming rows that are written already, the key set is
measured first and broadcast if it is small: the target is then read without a shuffle.
Otherwise both sides are shuffled, and adaptive execution can split skewed target
partitions or, after the shuffle, still join by broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import key_list, key_set, measured, on_keys, one_row_per_key, with_keys, without_keys
from sluiceway.operators.dedup import dedup
from sluiceway.operators.normalize import evolve_union

Key = str | Sequence[str] | None


def delete_flag(df: DataFrame, column: str) -> Column:
    """True for rows that delete: a true boolean, or any non-NULL value of another type."""
    col = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    return col.isNotNull()


def _surviving(incoming: DataFrame, hard_delete: str | None) -> DataFrame:
    return incoming.filter(~delete_flag(incoming, hard_delete)) if hard_delete else incoming


def delete_insert(
    target: DataFrame | None,
    incoming: DataFrame,
    primary_key: Key = None,
    merge_key: Key = None,
    hard_delete: str | None = None,
    dedup_sort: Mapping[str, str] | None = None,
    measure: bool = False,
) -> DataFrame:
    """Remove target rows whose primary key or merge key arrives, then insert the arrivals.

    Incoming rows are first reduced to one per primary key. Flagged rows delete
    their keys and are not inserted.
    """
    pk, mk = key_list(primary_key), key_list(merge_key)
    if not pk and not mk:
        raise ValueError("delete-insert needs a primary key or a merge key")
    rows = dedup(incoming, pk, dedup_sort) if pk else incoming
    if target is None:
        return _surviving(rows, hard_delete)
    kept = target
    if pk:
        # the dedup keeps every primary key, so the narrow un-deduplicated keys suffice
        kept = without_keys(kept, _keys(incoming, pk, measure), pk)
    if mk:
        kept = without_keys(kept, _keys(rows, mk, measure), mk)
    return evolve_union(kept, _surviving(rows, hard_delete))


def _keys(rows: DataFrame, keys: Sequence[str], measure: bool) -> DataFrame:
    return measured(key_set(rows, keys)) if measure else key_set(rows, keys)


def upsert(target: DataFrame | None, incoming: DataFrame, primary_key: Key, hard_delete: str | None = None, measure: bool = False) -> DataFrame:
    """Update rows whose key exists, insert the others; a repeated incoming key is an error.

    Columns the incoming rows lack keep the target's value. A flagged row deletes
    its key; when the key is unknown it has no effect.
    """
    keys = key_list(primary_key)
    if not keys or not all(k.strip() for k in keys):
        raise ValueError("upsert needs a non-empty primary key")
    rows = one_row_per_key(incoming, keys, "upsert")
    live = _surviving(rows, hard_delete)
    if target is None:
        return live
    arrived = _keys(incoming, keys, measure)
    kept = without_keys(target, arrived, keys)
    carried = [c for c in target.columns if c not in incoming.columns]
    if carried:
        # only the matching target rows, found by the (broadcastable) keys, take part in the outer join
        matched = with_keys(target, arrived, keys)
        old = matched.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
                            *[F.col(f"`{c}`") for c in carried])
        live = live.join(old, on_keys(keys), "left").drop(*[f"__k{i}" for i in range(len(keys))])
    return evolve_union(kept, live)


def merge_children(
    old_children: DataFrame, new_children: DataFrame, removed_roots: DataFrame, root_id: str = "_root_id"
) -> DataFrame:
    """Child rows after a merge of their roots.

    `removed_roots` holds the row ids of root rows that left the root table; their
    children go with them and the new children are added.
    """
    gone = key_set(removed_roots, [removed_roots.columns[0]])
    return evolve_union(without_keys(old_children, gone, [root_id]), new_children)
