"""A parquet dataset whose tables change together.

Rows are written to new folders that nobody reads; one small commit document,
written last, names the folders that make up every table. A reader sees the old
or the new state, never a mix, and a failed or repeated task leaves only folders
no commit names. The commit also carries the load ledger, the schema versions,
the incremental state and the last stream batch, so none of them can disagree
with the data.

A table may be split by a hash of its scope columns into buckets. A merge whose
keys contain the scope rewrites only the buckets its incoming rows fall into, and of
those only the files that hold one of their keys: the others stay by name. A state's
paths are therefore folders and, where part of a folder was replaced, single files.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import key_set, measured, with_keys
from sluiceway.operators.normalize import evolve_union
from sluiceway.operators.scd2 import Scd2, scd2_change
from sluiceway.sinks import storage

HISTORY_BUCKET = -1
_LAYOUT = ("__v", "__bucket")
_COMMIT_TRIES = 10
#: Keys of a batch that are given to the scan for stored keys as literals; more are joined.
LITERAL_KEYS = 1000
_LITERAL_TYPES = (T.IntegralType, T.StringType, T.DateType)


@dataclass(frozen=True)
class TableState:
    """One table as a commit describes it."""

    name: str
    schema: T.StructType
    paths: tuple[str, ...] = ()
    scope: tuple[str, ...] = ()
    buckets: int = 1
    schema_version: int = 1
    previous_hashes: tuple[str, ...] = ()
    rows_written: int = 0
    bytes_written: int = 0
    metrics: Mapping[str, object] = field(default_factory=dict)
    based_on: tuple[str, ...] | None = None  # the folders a merge or append started from
    type2: Mapping[str, object] | None = None  # how a type-2 table marks its versions

    @property
    def schema_hash(self) -> str:
        return schema_hash(self.schema)

    def to_json(self, changed: bool) -> dict:
        return {
            "name": self.name, "schema": self.schema.json(), "schema_hash": self.schema_hash,
            "schema_version": self.schema_version, "previous_hashes": list(self.previous_hashes),
            "paths": list(self.paths), "scope": list(self.scope), "buckets": self.buckets,
            "rows_written": self.rows_written, "bytes_written": self.bytes_written, "changed": changed,
            **({"type2": dict(self.type2)} if self.type2 else {}),
        }

    @staticmethod
    def from_json(doc: dict) -> "TableState":
        return TableState(
            doc["name"], T.StructType.fromJson(json.loads(doc["schema"])), tuple(doc["paths"]), tuple(doc["scope"]),
            doc["buckets"], doc["schema_version"], tuple(doc["previous_hashes"]), doc["rows_written"], doc["bytes_written"],
            type2=doc.get("type2"),
        )


def schema_hash(schema: T.StructType) -> str:
    """Hash of names and types; nullability depends on the reader and is left out."""
    named = [[f.name, f.dataType.simpleString()] for f in schema.fields]
    return hashlib.sha256(json.dumps(named).encode()).hexdigest()


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    if not columns:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]), F.lit(buckets)).cast("int")


def _is_folder(path: str) -> bool:
    return "/__bucket=" not in path or "/" not in path.split("/__bucket=")[1]


def _tail(file: str) -> str:
    """Folders and name of a file within its table, whatever form the path before them has."""
    return "/".join(file.split("/")[-3:])


def _bucket_in(path: str) -> int:
    return int(path.split("/__bucket=")[1].split("/")[0])


class Dataset:
    """Tables under one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # ---- reading ----

    def commits(self) -> list[str]:
        return [n for n in storage.list_names(self.spark, f"{self.base}/_commits") if n.endswith(".json") and n[0] != "."]

    def latest(self) -> dict:
        names = self.commits()
        if not names:
            return {"version": 0, "tables": [], "state": [], "streams": []}
        return storage.read_json(self.spark, f"{self.base}/_commits/{names[-1]}")

    def table(self, name: str, commit: dict | None = None) -> TableState | None:
        found = [t for t in (commit or self.latest())["tables"] if t["name"] == name]
        return TableState.from_json(found[0]) if found else None

    def child_tables(self, root: str, commit: dict | None = None) -> list[str]:
        """Stored tables that hold lists of a root table's rows."""
        found = (commit or self.latest())["tables"]
        return [t["name"] for t in found if t["name"].startswith(f"{root}__") and "_root_id" in TableState.from_json(t).schema.names]

    def read(self, name: str, commit: dict | None = None) -> DataFrame | None:
        state = self.table(name, commit)
        return None if state is None else self.rows(state, state.paths)

    def rows(self, state: TableState, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        layout = T.StructType([T.StructField("__v", T.StringType()), T.StructField("__bucket", T.IntegerType())])
        stored = T.StructType(state.schema.fields + layout.fields)
        return (
            self.spark.read.schema(stored).option("basePath", f"{self.base}/{state.name}").parquet(*paths).drop(*_LAYOUT)
        )

    def difference(self, paths: Sequence[str], others: Sequence[str]) -> tuple[str, ...]:
        """What `paths` hold and `others` do not. Folders named by both are left out unseen; the
        rest is compared file by file, as one side may name a folder and the other files of it."""
        mine, theirs = ([p for p in a if p not in set(b)] for a, b in ((paths, others), (others, paths)))
        parents = {p.rsplit("/", 1)[0] for p in theirs}
        kept = set(theirs) | {f for p in theirs if _is_folder(p) for f in storage.files_in(self.spark, p)} if theirs else set()
        out: list[str] = []
        for p in mine:
            if _is_folder(p) and p in parents:
                out += [f for f in storage.files_in(self.spark, p) if f not in kept]
            elif p not in kept:
                out.append(p)
        return tuple(out)

    def _holding(self, state: TableState, paths: Sequence[str], keys: DataFrame, match: Sequence[Sequence[str]]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """The files below `paths`, as (with, without) a row that has, for one of the column lists in `match`, the values of a row of `keys`.

        Only the key columns of the stored rows are read. Few keys go to the scan as literals, so
        that row groups out of their range are skipped; a commit names the files anyway.
        """
        found: set[str] = set()
        for columns in match:
            stored = self.rows(state, paths).select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("__file"))
            wanted, few = key_set(keys, columns), None
            if len(columns) == 1 and isinstance(state.schema[columns[0]].dataType, _LITERAL_TYPES):
                few = [r[0] for r in wanted.distinct().limit(LITERAL_KEYS + 1).collect()]
            if few is not None and len(few) <= LITERAL_KEYS and None not in few:
                hit = stored.filter(F.col(f"`{columns[0]}`").isin(few))
            else:
                hit = with_keys(stored, measured(wanted), columns)
            found.update(_tail(r[0]) for r in hit.select("__file").distinct().collect())
        hit_folders = {t.rsplit("/", 1)[0] for t in found}
        files = [f for p in paths for f in (storage.files_in(self.spark, p) if _is_folder(p) and "/".join(p.split("/")[-2:]) in hit_folders else [p])]
        return tuple(f for f in files if _tail(f) in found), tuple(f for f in files if _tail(f) not in found)

    # ---- writing ----

    def stage(
        self, name: str, df: DataFrame, bucket: Column | None = None, spread: Sequence[str] = (),
        observe: Sequence[Column] = (), without: Sequence[str] = (),
    ) -> TableState:
        """Write rows into a new folder; counts and asked-for aggregates come from the same pass.

        Columns named in `without` may decide the bucket but are not stored. `spread`
        asks for a rebalance on the bucket so that each bucket becomes a few full-size
        files; adaptive execution splits a bucket that is too large. The aggregates are
        taken after it, in the writing stage, where a task counts once however often
        it has to run.
        """
        token = uuid.uuid4().hex[:12]
        seen = Observation(f"stage-{token}")
        rows = df if bucket is None else df.withColumn("__bucket", bucket)
        if spread:
            rows = rows.hint("rebalance", *[F.col(c) for c in spread])
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *observe).drop(*without)
        folder = f"{self.base}/{name}/__v={token}"
        if bucket is None:
            rows.write.parquet(f"{folder}/__bucket=0")
        else:
            rows.write.partitionBy("__bucket").parquet(folder)
        paths = storage.matching(self.spark, f"{folder}/__bucket=*")
        metrics = dict(seen.get)
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name not in without])
        return TableState(name, nullable, tuple(paths), rows_written=metrics.pop("rows", 0),
                          bytes_written=storage.size_of(self.spark, paths), metrics=metrics)

    def commit(
        self, changes: Sequence[TableState], load_id: str = "", pipeline: str = "", drop: Sequence[str] = (),
        state: Mapping[str, dict] | None = None, stream: Mapping[str, object] | None = None, also: Sequence[TableState] = (),
    ) -> dict:
        """Publish new table states, incremental state and stream progress in one step.

        Refused when a table moved on since its new state was computed. `also` are states that
        every commit of a load carries besides its own tables.
        """
        changes = [*changes, *also]
        for _ in range(_COMMIT_TRIES):
            doc = self._next_commit(changes, load_id, pipeline, drop, state, stream)
            try:
                storage.write_json_once(self.spark, f"{self.base}/_commits/{doc['version']:012d}.json", doc)
                return doc
            except FileExistsError:
                continue  # another load was first; on top of it, if it left our tables alone
        raise RuntimeError(f"{self.base} is being committed to all the time; run again")

    def _next_commit(self, changes, load_id, pipeline, drop, state, stream) -> dict:
        before = self.latest()
        known = {t["name"]: t for t in before["tables"]}
        tables = {n: {**t, "changed": False} for n, t in known.items() if n not in drop}
        for change in changes:
            old = known.get(change.name)
            if change.based_on is not None and change.based_on != tuple(old["paths"] if old else ()):
                raise RuntimeError(f"table {change.name} was changed by another load; run again")
            if old is None:
                now = change
            elif old["schema_hash"] == change.schema_hash:
                now = replace(change, schema_version=old["schema_version"], previous_hashes=tuple(old["previous_hashes"]))
            else:
                now = replace(change, schema_version=old["schema_version"] + 1,
                              previous_hashes=(old["schema_hash"], *old["previous_hashes"]))
            tables[change.name] = now.to_json(changed=True)
        states = {s["resource"]: s for s in before["state"]}
        for resource, value in (state or {}).items():
            states[resource] = {"resource": resource, **value}
        streams = {s["name"]: s for s in before["streams"]}
        if stream:
            streams[stream["name"]] = dict(stream)
        return {
            "version": before["version"] + 1, "load_id": load_id, "pipeline": pipeline, "status": 0,
            "committed_at": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"),
            "tables": list(tables.values()), "state": list(states.values()), "streams": list(streams.values()),
        }

    # ---- dispositions: each returns the staged state to commit ----

    def append(
        self, name: str, df: DataFrame, observe: Sequence[Column] = (), without: Sequence[str] = ()
    ) -> TableState:
        """New folders next to the old ones; nothing is read or rewritten."""
        old = self.table(name)
        if old is None:
            return replace(self.stage(name, df, observe=observe, without=without), based_on=())
        bucket = bucket_of(old.scope, old.buckets) if old.scope and old.buckets > 1 else None
        new = self.stage(name, self._fitted(old, df), bucket, [] if bucket is None else ["__bucket"], observe, without)
        return replace(new, schema=self._merged_schema(old, new), paths=old.paths + new.paths,
                       scope=old.scope, buckets=old.buckets, based_on=old.paths)

    def _fitted(self, old: TableState, df: DataFrame) -> DataFrame:
        """Rows in the table's column types; a type that must widen needs a rewrite."""
        grown = evolve_union(self.rows(old, []), df)
        for f in old.schema.fields:
            if grown.schema[f.name].dataType != f.dataType:
                raise ValueError(
                    f"column {f.name} would widen from {f.dataType.simpleString()} to "
                    f"{grown.schema[f.name].dataType.simpleString()}; append cannot rewrite stored files, merge or replace can"
                )
        present = [c for c in grown.columns if c in df.columns]
        return df.select(*[F.col(f"`{c}`").cast(grown.schema[c].dataType).alias(c) for c in present])

    @staticmethod
    def _merged_schema(old: TableState, new: TableState) -> T.StructType:
        return T.StructType(old.schema.fields + [f for f in new.schema.fields if f.name not in old.schema.names])

    def merge(
        self, name: str, incoming: DataFrame, fn: Callable[[DataFrame | None, DataFrame], DataFrame],
        scope: Sequence[str] = (), buckets: int = 1, observe: Sequence[Column] = (), touch: DataFrame | None = None,
        match: Sequence[Sequence[str]] = (), affected: tuple[tuple[str, ...], tuple[str, ...]] | None = None,
    ) -> TableState:
        """Apply a merge function to the part of the table that incoming rows can affect.

        `scope` must be part of the match key of `fn`: rows of one key then always
        share a bucket, and only buckets with incoming rows are read and rewritten.
        `match` lists the keys by which `fn` finds stored rows: files without a row that
        has one of them stay as they are. `touch` names other rows that decide both; `affected` says both at once.
        """
        old = self.table(name)
        bucket = bucket_of(scope, buckets) if scope and buckets > 1 else None
        spread = ["__bucket"] if bucket is not None else []
        if old is None:
            new = self.stage(name, fn(None, incoming), bucket, spread, observe)
            return replace(new, scope=tuple(scope), buckets=buckets, based_on=())
        touched, left = affected or self._affected(old, incoming, scope, buckets, touch, match)
        result = fn(self.rows(old, touched), incoming)
        if left and self._widened(old, result):
            # a column's type must be the same in every file
            touched, left = old.paths, ()
            result = fn(self.rows(old, touched), incoming)
        new = self.stage(name, result, bucket, spread, observe)
        return replace(new, schema=self._merged_schema(old, new) if left else new.schema,
                       paths=left + new.paths, scope=tuple(scope), buckets=buckets, based_on=old.paths)

    def _affected(
        self, old: TableState, incoming: DataFrame, scope: Sequence[str], buckets: int, touch: DataFrame | None, match: Sequence[Sequence[str]]
    ) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """The paths that incoming rows can affect, and the others."""
        touched, split = old.paths, bool(scope) and buckets > 1
        if split and self._same_split(old, incoming, scope, buckets):
            hit = {r[0] for r in (incoming if touch is None else touch).select(bucket_of(scope, buckets)).distinct().collect()}  # at most `buckets` integers
            touched = tuple(p for p in old.paths if _bucket_in(p) in hit)
        left = tuple(p for p in old.paths if p not in set(touched))
        if match and touched and (touch is not None or not self._retyped(old, incoming, match)) and (not split or self._same_split(old, incoming, scope, buckets)):
            touched, spared = self._holding(old, touched, incoming if touch is None else touch, match)
            left += spared
        return touched, left

    def stored(
        self, name: str, incoming: DataFrame, arrived: DataFrame, keys: Sequence[str], buckets: int = 1
    ) -> tuple[DataFrame | None, tuple[tuple[str, ...], tuple[str, ...]] | None]:
        """The stored rows whose keys arrived, and for `merge` the (affected, other) paths of the table."""
        old = self.table(name)
        if old is None:
            return None, None
        affected = self._affected(old, incoming, keys, buckets, None, [keys])
        return with_keys(self.rows(old, affected[0]), arrived, keys), affected

    @staticmethod
    def _retyped(old: TableState, incoming: DataFrame, match: Sequence[Sequence[str]]) -> bool:
        """Whether a key column is new or has another type than in the stored files."""
        return any(c not in old.schema.names or old.schema[c].dataType != incoming.schema[c].dataType for columns in match for c in columns)

    @staticmethod
    def _widened(old: TableState, rows: DataFrame) -> bool:
        return any(rows.schema[f.name].dataType != f.dataType for f in old.schema.fields if f.name in rows.columns)

    @staticmethod
    def _same_split(old: TableState, incoming: DataFrame, scope: Sequence[str], buckets: int) -> bool:
        same = old.scope == tuple(scope) and old.buckets == buckets
        return same and all(old.schema[c].dataType == incoming.schema[c].dataType for c in scope)

    def merge_scd2(
        self, name: str, incoming: DataFrame, boundary: Column, cfg: Scd2 = Scd2(), buckets: int = 1,
        observe: Sequence[Column] = (),
    ) -> TableState:
        """Type-2 merge that never rewrites history.

        Retired versions are appended to their own bucket and stay there; only
        active versions (of the loaded scope) are read and rewritten. The table keeps
        how its versions are marked: after a change of the active marker every active
        version is rewritten once, other column names are refused.
        """
        marks = {"columns": list(cfg.columns), "active_until": cfg.active_until, "hash_column": cfg.hash_column}
        scope = tuple(cfg.natural_key or cfg.partition_key)
        active_bucket = bucket_of(scope, buckets) if scope and buckets > 1 else F.lit(0)
        spread = ["__bucket"] if scope and buckets > 1 else []
        old = self.table(name)
        touched, left, marked = (), (), (old.type2 if old is not None else None) or marks
        for kept in ("columns", "hash_column"):
            if marked[kept] != marks[kept]:
                raise ValueError(f"type-2 {kept} of table {name} changed from {marked[kept]} to {marks[kept]}; replace the table instead")
        remark = marked["active_until"] != cfg.active_until
        if old is not None:
            live = tuple(p for p in old.paths if _bucket_in(p) != HISTORY_BUCKET)
            touched = live
            if spread and not remark and self._same_split(old, incoming, scope, buckets):
                hit = {r[0] for r in incoming.select(active_bucket).distinct().collect()}  # at most `buckets` integers
                touched = tuple(p for p in live if _bucket_in(p) in hit)
            left = tuple(p for p in old.paths if p not in set(touched))
        target = None if old is None else self.rows(old, touched)
        if remark:
            # outside the history folders every stored version is an active one
            target = target.withColumn(cfg.columns[1], F.lit(cfg.active_until).cast("timestamp_ntz"))
        versions = scd2_change(target, incoming, boundary, cfg).versions
        if left and self._widened(old, versions):
            # the one case that rewrites history: a column's type must be the same in every file
            past = self.rows(old, tuple(p for p in old.paths if _bucket_in(p) == HISTORY_BUCKET)).withColumn("__retired", F.lit(True))
            active = self.rows(old, live)
            if remark:
                active = active.withColumn(cfg.columns[1], F.lit(cfg.active_until).cast("timestamp_ntz"))
            change = scd2_change(active, incoming, boundary, cfg)
            versions = evolve_union(past, change.versions)
            left = ()
        bucket = F.when(F.col("__retired"), HISTORY_BUCKET).otherwise(active_bucket)
        new = self.stage(name, versions, bucket, spread, observe, without=("__retired",))
        schema = self._merged_schema(old, new) if left else new.schema
        return replace(new, schema=schema, paths=left + new.paths, scope=scope, buckets=buckets,
                       based_on=() if old is None else old.paths, type2=marks)

    def compact(self, name: str) -> TableState:
        """The same rows in fewer, larger files, for tables that many small appends have cut up."""
        state = self.table(name)
        in_history = F.col("_metadata.file_path").contains(f"__bucket={HISTORY_BUCKET}/")
        bucket = F.when(in_history, HISTORY_BUCKET).otherwise(bucket_of(state.scope, state.buckets))
        new = self.stage(name, self.rows(state, state.paths).withColumn("__b", bucket), F.col("__b"), ["__bucket"], without=("__b",))
        return replace(state, paths=new.paths, rows_written=new.rows_written, bytes_written=new.bytes_written, based_on=state.paths)

    def expire(self, keep: int = 1) -> list[str]:
        """Delete data folders that none of the last `keep` commits names, except staged newer ones."""
        names = self.commits()
        if len(names) <= keep:
            return []
        docs = [storage.read_json(self.spark, f"{self.base}/_commits/{n}") for n in names]
        used = {p for d in docs[-keep:] for t in d["tables"] for p in t["paths"]}
        named = {p for d in docs[:-keep] for t in d["tables"] for p in t["paths"]} - used
        folders = {p for p in named if _is_folder(p)}
        gone = sorted(self.difference([p for p in named if p in folders or p.rsplit("/", 1)[0] not in folders], used))
        for path in gone:
            storage.remove(self.spark, path)
        return gone
