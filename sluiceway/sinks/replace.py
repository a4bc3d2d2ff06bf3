"""The three ways to replace a table, and append, as committed steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame

from sluiceway.sinks.dataset import Dataset, TableState

# Replace strategies, the first is the default.
REPLACE_STRATEGIES = ("truncate-and-insert", "insert-from-staging", "staging-optimized")


def replace_tables(
    dataset: Dataset, tables: Mapping[str, DataFrame], strategy: str = REPLACE_STRATEGIES[0],
    observe: Sequence[Column] = (), without: Sequence[str] = (), about: Callable[[Mapping], dict] | None = None, **commit
) -> dict[str, TableState]:
    """Replace tables by the given rows.

    truncate-and-insert: the tables are emptied first, so a reader may find them
    empty until the insert is committed. insert-from-staging: everything is
    written aside, then root and child tables switch in one commit; the table
    keeps its known columns. staging-optimized: as before, but the table is
    dropped and created anew with the incoming schema. `about` makes the commit's
    facts from what was observed while the first table was written.
    """
    if strategy not in REPLACE_STRATEGIES:
        raise ValueError(f"invalid replace strategy: {strategy}")
    before = dataset.latest()
    old = {n: dataset.table(n, before) for n in tables}
    if strategy == "truncate-and-insert":
        emptied = [TableState(n, t.schema) for n, t in old.items() if t is not None]
        if emptied:
            dataset.commit(emptied)
    # child tables that the new rows no longer have are emptied, or dropped, with their root
    gone = [n for n in dataset.child_tables(next(iter(tables)), before) if n not in tables]
    staged = {n: dataset.stage(n, df, observe=observe, without=without) for n, df in tables.items()}
    if about is not None:
        commit = about(next(iter(staged.values())).metrics)
    if strategy == "staging-optimized":
        dataset.commit(list(staged.values()), drop=[*tables, *gone], **commit)
        return staged
    for name, state in old.items():
        if state is not None:
            staged[name] = _keep_columns(state, staged[name])
    emptied = [TableState(n, dataset.table(n, before).schema) for n in gone]
    dataset.commit([*staged.values(), *emptied], **commit)
    return staged


def _keep_columns(old: TableState, new: TableState) -> TableState:
    """The new rows under the table's known columns; absent ones read as NULL."""
    known = [new.schema[f.name] if f.name in new.schema.names else f for f in old.schema.fields]
    added = [f for f in new.schema.fields if f.name not in old.schema.names]
    return replace(new, schema=type(new.schema)(known + added))
