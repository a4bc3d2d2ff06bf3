"""Bounded and continuous streams into a dataset, exactly once per micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.keys import key_set, measured, without_keys
from sluiceway.operators import merge as merges
from sluiceway.operators.dedup import dedup
from sluiceway.operators.newest import ALIVE, DELETED, SET, newest_wins, remembered
from sluiceway.operators.normalize import evolve_union
from sluiceway.operators.scd2 import Scd2, boundary_time
from sluiceway.sinks import storage
from sluiceway.sinks.dataset import Dataset, TableState

MESSAGE_KEY = ("topic", "partition", "offset")


@dataclass(frozen=True)
class Write:
    """What to do with a batch: one new table state, or several. A batch that is read more than once
    (by a merge) is first written as a package, so that its source is read once."""

    apply: Callable[[Dataset, DataFrame, int], TableState | list[TableState]]
    packaged: bool = True


def appender(table: str) -> Write:
    """Add every row of the batch."""
    return Write(lambda dataset, rows, batch_id: dataset.append(table, rows), packaged=False)


def upserter(
    table: str, keys: Sequence[str], newest: Mapping[str, str] | None = None, hard_delete: str | None = None, buckets: int = 1
) -> Write:
    """One row per key. With `newest` ({column: asc|desc}) the first in that order wins, also
    against what is stored: late rows never overwrite newer ones nor bring back a key that was
    deleted after them, and columns a row lacks keep their value. Without it a batch must hold each key once
    and replaces what is stored.
    """
    scope = list(keys)

    def latest(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return dedup(new if old is None else evolve_union(old, new), keys, newest)

    def plain(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return merges.upsert(old, new, keys, hard_delete)

    def apply(dataset: Dataset, rows: DataFrame, batch_id: int) -> TableState | list[TableState]:
        stored = dataset.table(table)
        whole = stored is None or set(stored.schema.names) == set(rows.columns)
        if newest is None:
            return dataset.merge(table, rows, plain, scope, buckets, match=[scope])
        if hard_delete is None and whole and dataset.table(memory_of(table)) is None:
            return dataset.merge(table, rows, latest, scope, buckets)  # nothing to remember: every row has every column, none deletes
        return _remembering(dataset, rows)

    def _remembering(dataset: Dataset, rows: DataFrame) -> list[TableState]:
        memory = memory_of(table)
        stored = dataset.table(table)
        if stored is not None and set(rows.columns) - set(stored.schema.names):
            # a new column: every stored row has to know that it never had it
            held = {n: (dataset.read(n), (state.paths, ()) if (state := dataset.table(n)) else None) for n in (table, memory)}
        else:
            arrived = measured(key_set(rows, scope))
            held = {n: dataset.stored(n, rows, arrived, scope, buckets) for n in (table, memory)}
        (old, in_table), (past, in_memory) = held[table], held[memory]
        found = newest_wins(rows, old, past, keys, newest, hard_delete)
        noted = F.count_if(F.col(DELETED).isNotNull() | (F.size(SET) > 0)).alias("noted")
        package = dataset.stage(f"_packages/{uuid.uuid4().hex[:12]}", found, observe=[noted])
        try:
            done = dataset.rows(package, package.paths)
            settled = measured(key_set(done, scope)) if old is not None else None

            def follow(pick: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
                def fn(old: DataFrame | None, new: DataFrame) -> DataFrame:
                    return pick(new) if old is None else evolve_union(without_keys(old, settled, scope), pick(new))

                return fn

            living = follow(lambda new: new.filter(ALIVE).drop(ALIVE, DELETED, SET))
            changes = [dataset.merge(table, done, living, scope, buckets, affected=in_table)]
            if package.metrics["noted"] or dataset.table(memory) is not None:
                changes.append(dataset.merge(memory, done, follow(lambda new: remembered(new, scope)), scope, buckets, affected=in_memory))
            return changes
        finally:
            storage.remove(dataset.spark, f"{dataset.base}/{package.name}")

    return Write(apply)


def memory_of(table: str) -> str:
    """The table that keeps deletes and partial columns of a newest-wins upsert."""
    return f"_memory_{table}"


def delete_inserter(table: str, primary_key: Sequence[str] = MESSAGE_KEY, buckets: int = 1, **settings) -> Write:
    """Delete-insert per batch; by default a message delivered again replaces itself."""

    def fn(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return merges.delete_insert(old, new, primary_key, **settings)

    return Write(lambda dataset, rows, batch_id: dataset.merge(table, rows, fn, list(primary_key), buckets, match=[list(primary_key)]))


def historian(table: str, run_time: Callable[[int], str], cfg: Scd2, buckets: int = 1) -> Write:
    """Type-2 merge per batch; `run_time` gives the boundary of a batch."""
    return Write(lambda dataset, rows, batch_id: dataset.merge_scd2(table, rows, boundary_time(run_time(batch_id)), cfg, buckets))


def start(
    stream: DataFrame,
    base: str,
    name: str,
    write: Write,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream: bounded (all that exists now) unless a processing interval is given.

    The checkpoint's id and the batch id are published in the same commit as the
    batch's rows, so a batch that is run again after a failure is recognised and
    skipped. A new checkpoint is a new stream and reads from its start position.
    """

    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        dataset = Dataset(spark, base)
        checkpoint_id = storage.read_json(spark, f"{checkpoint}/metadata")["id"]
        done = [s for s in dataset.latest()["streams"] if s["name"] == name and s["checkpoint_id"] == checkpoint_id]
        if done and batch_id <= done[0]["batch_id"]:
            return
        rows, package = prepare(batch) if prepare else batch, None
        try:
            if write.packaged:
                package = Dataset(batch.sparkSession, base).stage(f"_packages/{uuid.uuid4().hex[:12]}", rows)
                rows = dataset.rows(package, package.paths)
            change = write.apply(dataset, rows, batch_id)
            progress = {"name": name, "checkpoint_id": checkpoint_id, "batch_id": batch_id}
            dataset.commit(change if isinstance(change, list) else [change], load_id=f"{name}-{batch_id}", pipeline=name, stream=progress)
        finally:
            if package is not None:
                storage.remove(spark, f"{base}/{package.name}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
