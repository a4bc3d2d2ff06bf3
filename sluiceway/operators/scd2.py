"""Slowly changing dimension, type 2: row versions with validity intervals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.keys import key_list, key_set, one_row_per_key, with_keys, without_keys
from sluiceway.operators.normalize import evolve_union

# Default validity columns and the end of an active version.
VALIDITY_COLUMNS = ("valid_from", "valid_to")
ACTIVE_UNTIL = "9999-12-31"


@dataclass(frozen=True)
class Scd2:
    """Settings of one table; natural and partition key exclude each other."""

    natural_key: Sequence[str] = field(default_factory=tuple)
    partition_key: Sequence[str] = field(default_factory=tuple)
    columns: Sequence[str] = VALIDITY_COLUMNS
    active_until: str | None = ACTIVE_UNTIL
    hash_column: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "natural_key", key_list(self.natural_key))
        object.__setattr__(self, "partition_key", key_list(self.partition_key))
        if self.natural_key and self.partition_key:
            raise ValueError("only one of natural and partition merge key may be given")
        if len(self.columns) != 2:
            raise ValueError("validity column names must be exactly two")


@dataclass(frozen=True)
class Scd2Change:
    """A new state in two parts: `history` is untouched and need not be rewritten; `versions`
    holds the active ones and, marked by `__retired`, those this run has closed."""

    history: DataFrame | None
    versions: DataFrame

    def state(self) -> DataFrame:
        versions = self.versions.drop("__retired")
        return versions if self.history is None else evolve_union(self.history, versions)


def version_id(columns: Sequence[str], start: str) -> Column:
    """Unique id of a row version: its content and its start. A NULL column does not count, so
    a column added later leaves the ids of older versions alone."""
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]))
    return F.sha2(F.concat_ws("|", content, F.col(f"`{start}`").cast("string")), 256)


def boundary_time(run_time: datetime | str, to_minute: bool = False) -> Column:
    """Start of this run's versions, optionally floored to the minute."""
    at = F.lit(str(run_time)).cast("timestamp_ntz")
    return F.date_trunc("minute", at).cast("timestamp_ntz") if to_minute else at


def scd2_change(target: DataFrame | None, incoming: DataFrame, boundary: Column, cfg: Scd2 = Scd2()) -> Scd2Change:
    """Compare a snapshot or batch with the active versions.

    A row version is identified by its whole content. Active versions missing from
    the incoming rows are retired when they are in scope: every one for a full
    snapshot, those whose natural key arrived, or those of a loaded partition.
    Unknown contents become new active versions; columns one side lacks are NULL.

    One shuffle does it all: active and incoming rows are grouped by content, and
    which sides a group came from tells its fate. Repeated incoming rows collapse
    before the shuffle, so no content is hot.
    """
    start, end = cfg.columns
    open_end = F.lit(cfg.active_until).cast("timestamp_ntz")
    arrived = incoming
    if cfg.natural_key:
        incoming = one_row_per_key(incoming, cfg.natural_key, "scd2")
    own = [start, end] + ([cfg.hash_column] if cfg.hash_column else [])
    new = incoming.withColumns({"__old": F.lit(0), "__new": F.lit(1)})
    if target is None:
        first = _distinct(incoming).withColumns({start: boundary, end: open_end, "__retired": F.lit(False)})
        return Scd2Change(None, _with_id(first, incoming.columns, cfg))

    is_open = F.col(f"`{end}`").isNull() if cfg.active_until is None else F.col(f"`{end}`").eqNullSafe(open_end)
    history, active = target.filter(~is_open), target.filter(is_open)
    outside = None
    scope = cfg.natural_key or cfg.partition_key
    if scope:
        loaded = key_set(arrived, scope)
        outside = without_keys(active, loaded, scope)
        active = with_keys(active, loaded, scope)
    old = active.drop(*[c for c in own if c != start]).withColumns({"__old": F.lit(1), "__new": F.lit(0)})
    both = evolve_union(old, new)
    business = [c for c in both.columns if c not in (start, "__old", "__new")]
    rows = both.groupBy(*[F.col(f"`{c}`") for c in business]).agg(
        F.max("__old").alias("__old"), F.max("__new").alias("__new"), F.min(F.col(f"`{start}`")).alias(start))
    versions = rows.withColumns({
        start: F.when(F.col("__old") == 0, boundary).otherwise(F.col(f"`{start}`")),
        end: F.when(F.col("__new") == 1, open_end).otherwise(boundary),
        "__retired": F.col("__new") == 0,
    }).drop("__old", "__new")
    versions = _with_id(versions, business, cfg)
    if outside is not None:
        versions = evolve_union(outside.withColumn("__retired", F.lit(False)), versions)
    return Scd2Change(history, versions)


def _distinct(rows: DataFrame) -> DataFrame:
    """Rows without repeats; grouping takes map columns, `distinct` does not."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.lit(1).alias("__one")).drop("__one")


def _with_id(rows: DataFrame, business: Sequence[str], cfg: Scd2) -> DataFrame:
    return rows.withColumn(cfg.hash_column, version_id(business, cfg.columns[0])) if cfg.hash_column else rows


def scd2(target: DataFrame | None, incoming: DataFrame, boundary: Column, cfg: Scd2 = Scd2()) -> DataFrame:
    """The whole new state: history, newly retired and active versions."""
    return scd2_change(target, incoming, boundary, cfg).state()
