"""Run a job: check the specification, then load each resource in order."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import key_set, measured, with_keys, without_keys
from sluiceway.functions.names import snake_case, snake_columns
from sluiceway.operators import merge as merges
from sluiceway.operators.dedup import dedup
from sluiceway.operators.incremental import cursor_predicate, cursor_text, ordered, whole_ties
from sluiceway.operators.normalize import detect_iso_timestamps, flatten, relational, with_load_id, with_row_id
from sluiceway.operators.rules import apply_rules
from sluiceway.operators.scd2 import boundary_time, scd2
from sluiceway.plans import manifest
from sluiceway.plans.spec import Resource, manifest_rows, resources
from sluiceway.sinks import external, ledger, storage
from sluiceway.sinks.dataset import Dataset, TableState
from sluiceway.sinks.external import DEFAULT_DATASET, destination
from sluiceway.sinks.replace import replace_tables
from sluiceway.sources.documents import limited
from sluiceway.sources.files import NoNewFiles
from sluiceway.sources.predicates import predicate
from sluiceway.sources import rejects, topics
from sluiceway.sources.registry import archived, decoded, open_source, open_stream

Reader = Callable[[SparkSession, str, str, Mapping], DataFrame]

_HELPERS = ("__cursor", "__modified")  # columns that only feed observations
_ACCEPTED: set[str] = set()
# Columns that loads add to tables or to their folders.
RESERVED = frozenset(("_row_id", "_load_id", "_root_id", "_parent_id", "__v", "__bucket", "__cursor"))


def validate(spark: SparkSession, spec: Mapping) -> None:
    """Raise with every error the manifest rules find; a specification once accepted is not checked again."""
    text = hashlib.sha256(json.dumps(spec, sort_keys=True, default=str).encode()).hexdigest()
    if text in _ACCEPTED:
        return
    checked = manifest.check(manifest_rows(spark, spec))
    bad = [e for row in checked.select("errors").collect() for e in row.errors]  # one row per resource of the job
    if bad:
        raise ValueError("; ".join(sorted(set(bad))))
    _ACCEPTED.add(text)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class _Trace:
    """Rows of the run's metrics table, written once at the end, also after a failure."""

    def __init__(self, run_id: str, spec: Mapping):
        about = (run_id, spec["identity"], spec["source_uri"].split(":")[0], spec["destination_uri"].split(":")[0])
        self._about = about
        self.rows: list[tuple] = []

    def add(self, step: str, name: str, started: datetime, rows: int | None, size: int | None, error: str | None = None):
        self.rows.append((*self._about, step, name, rows, size, started, _now(), error))

    def write(self, spark: SparkSession, base: str) -> None:
        rows = storage.small_frame(spark, self.rows, ledger.METRICS_SCHEMA)
        rows.coalesce(1).write.parquet(f"{base}/_run_metrics/{self._about[0]}")  # a folder of its own per run


def dataset_of(spark: SparkSession, spec: Mapping) -> Dataset:
    """The dataset a job loads into; for other destinations the one that keeps its state and ledger."""
    kind, options = destination(spec["destination_uri"])
    if kind != "dataset":
        if not spec.get("state_folder"):
            raise ValueError(f"a job into a {kind} destination needs a state_folder for its packages, state and ledger")
        return Dataset(spark, spec["state_folder"])
    name = dataset_name(spec)
    return Dataset(spark, f"{options['path']}/{name}" if name else options["path"])


def dataset_name(spec: Mapping) -> str:
    return spec.get("dataset_name") or DEFAULT_DATASET[spec["destination_uri"].split(":")[0].lower()]


def run(
    spark: SparkSession, spec: Mapping, run_time: datetime | None = None, reader: Reader = open_source,
    transform: Callable[[DataFrame], DataFrame] | None = None, dataset: Dataset | None = None, streamer: Reader = open_stream,
) -> dict:
    """Load every resource of a job; returns status, message, load id and rows per table.

    Per resource: read, keep new rows, apply column rules, normalise, write. Data, rejected
    rows, state and ledger are published by one commit per resource, or per batch of one that
    is resumed as a stream.
    """
    validate(spark, spec)
    run_time = run_time or _now()
    load_id = f"{run_time:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
    external = dataset is None and destination(spec["destination_uri"])[0] != "dataset"
    dataset = dataset or dataset_of(spark, spec)
    trace = _Trace(load_id, spec)
    counts: dict[str, int] = {}
    try:
        for res in resources(spec):
            load = _Load(spark, spec, res, dataset, load_id, run_time, trace, external)
            counts.update(load.resume(streamer, transform) if res.options.get("resume") else load.run(reader, transform))
    finally:
        if trace.rows:
            trace.write(spark, dataset.base)
    hashes = {t["name"]: t["schema_hash"] for t in dataset.latest()["tables"]}
    return {"status": "success", "message": "Data ingestion completed", "pipeline_name": spec["identity"],
            "load_id": load_id, "rows": counts, "schema_hashes": hashes}


def rejects_table(destination: str) -> str:
    """The table that keeps a destination's rejected rows."""
    return f"_rejects_{snake_case(destination)}"


def _in_bucket(paths: Sequence[str], bucket: int) -> list[str]:
    return [p for p in paths if p.endswith(f"/__bucket={bucket}")]


def _nested(schema: T.StructType) -> bool:
    def has(t: T.DataType) -> bool:
        if isinstance(t, (T.ArrayType, T.MapType)):
            return True
        return isinstance(t, T.StructType) and any(has(f.dataType) for f in t.fields)

    return any(has(f.dataType) for f in schema.fields)


def _later(a: str, b: str, direction: str) -> str:
    """The further of two cursor texts: numbers as numbers, dates and times as their ISO text. `a` is the new one."""
    if a.lstrip("-").isdigit() and ":" in b:
        return a  # an instant stored as text by an earlier version
    try:
        key = Decimal
        Decimal(a), Decimal(b)
    except ArithmeticError:
        key = str
    return max(a, b, key=key) if direction == "max" else min(a, b, key=key)


@dataclass
class _Load:
    """One resource of one run."""

    spark: SparkSession
    spec: Mapping
    res: Resource
    dataset: Dataset
    load_id: str
    run_time: datetime
    trace: _Trace
    external: bool
    progress: Mapping[str, object] | None = None  # of the stream whose batch this is
    apart: list[TableState] = field(default_factory=list)  # rejected rows, published with the tables

    def resume(self, streamer: Reader, transform: Callable[[DataFrame], DataFrame] | None) -> dict[str, int]:
        """The resource as a stream that goes on where its checkpoint stands and ends when all is read.

        Every batch is a load with a commit of its own, which carries the stream's progress: a batch that
        is run again after a failure is skipped. With `follow` the stream runs that many seconds,
        a batch every `batch_timeout` seconds.
        """
        res, options = self.res, {**self.res.options, "with_rejects": True}
        unfit = [n for n in ("limit", "new_files", "row_order") if options.get(n)] + ["incremental_config"] * (res.cursor is not None) + ["replace"] * (res.disposition == "replace")
        if unfit:
            raise ValueError(f"a resumed resource keeps its own place; it cannot have {', '.join(unfit)}")
        uri, checkpoint = self.spec["source_uri"], f"{self.dataset.base}/_checkpoints/{self._resource_id}"
        starts = self._starts(f"{checkpoint}-start", uri, options)
        counts: dict[str, int] = {}

        def each(batch: DataFrame, batch_id: int) -> None:
            checkpoint_id = storage.read_json(self.spark, f"{checkpoint}/metadata")["id"]
            done = [s for s in self.dataset.latest()["streams"] if s["name"] == self._resource_id and s["checkpoint_id"] == checkpoint_id]
            if done and batch_id <= done[0]["batch_id"]:
                return
            rows = batch if starts is None else topics.from_latest(batch, starts)
            progress = {"name": self._resource_id, "checkpoint_id": checkpoint_id, "batch_id": batch_id}
            load = _Load(self.spark, self.spec, res, self.dataset, f"{self.load_id}-{batch_id}", self.run_time, self.trace, self.external, progress)
            for name, n in load.run(lambda *_: decoded(rows, options), transform).items():
                counts[name] = counts.get(name, 0) + n

        stream = streamer(self.spark, uri, res.source, options)
        writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(f"{self._resource_id}-{uuid.uuid4().hex[:8]}")
        follow = options.get("follow")
        if follow:
            query = writer.trigger(processingTime=f"{options.get('batch_timeout') or topics.BATCH_TIMEOUT} seconds").start()
            query.awaitTermination(follow)
            query.stop()
        else:
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return counts

    def _starts(self, folder: str, uri: str, options: Mapping) -> DataFrame | None:
        """Start offsets of archived messages, settled by the first run: one row per topic partition."""
        if not storage.list_names(self.spark, folder):
            found = archived(self.spark, uri, self.res.source, options)
            if found is None:
                return None
            found.write.parquet(folder)
        return measured(self.spark.read.parquet(folder))

    def run(self, reader: Reader, transform: Callable[[DataFrame], DataFrame] | None) -> dict[str, int]:
        res, started, step = self.res, _now(), "extract"
        packages: list[TableState] = []
        try:
            df, observe = self._read(reader)
            taken = sorted(RESERVED.intersection(df.columns).difference(res.exclude))
            if taken:
                raise ValueError(f"source columns {', '.join(taken)} have names that the load needs; rename or exclude them")
            nulls = None
            if res.cursor:
                df, nulls, pick = self._new_rows(df)
                observe.append(pick)
            marked = rejects.is_marked(df)
            if marked and (transform or res.options.get("limit")):
                # limits and transformations are of good rows; the others are read beside them
                bad = df.filter(rejects.rejected()).select(*rejects.MARKS)
                df = self._limited(df.filter(~rejects.rejected()).drop(*rejects.MARKS))
                df = (transform(df) if transform else df).unionByName(bad, allowMissingColumns=True)
            else:
                df = self._limited(df)
                df = transform(df) if transform else df
            df = apply_rules(df, res.exclude, res.pseudonymize, self.spec.get("salt", ""))
            if self._is_direct(df):
                # keyed flat rows need no package: they are written once, where they stay
                step = "load"
                counts, metrics = self._write_direct(self._normalized(df), observe)
                self.trace.add("extract", res.source, started, sum(counts.values()), None)
            else:
                package = self._package(df, observe)
                packages.append(package)
                metrics = package.metrics
                self.trace.add(step, res.source, started, package.rows_written, package.bytes_written)
                started, step = _now(), "normalize"
                paths, rejected_paths = (_in_bucket(package.paths, n) for n in (0, 1))
                rows = self.dataset.rows(package, paths)
                if marked:
                    rows = rows.drop(*rejects.MARKS)
                    self._keep_rejected(package, rejected_paths, started)
                rows = self._without_repeats(rows, packages)
                if res.options.get("detect_timestamps"):
                    rows = detect_iso_timestamps(rows)
                tables = self._normalized(rows, empty=not paths)
                self.trace.add(step, res.destination, started, package.rows_written, package.bytes_written)
                started, step = _now(), "load"
                counts = self._write(tables, self._about(metrics))
                counts.update({t.name: t.rows_written for t in self.apart})
            for name, rows_written in counts.items():
                self.trace.add("load", name, started, rows_written, None)
            if nulls is not None:
                self.trace.add("extract", f"{res.source}:null_cursor", started, nulls.get.get("nulls", 0), None)
            return counts
        except NoNewFiles:
            self.trace.add("extract", res.source, started, 0, 0)
            return {}
        except Exception as failure:
            self.trace.add(step, res.destination, started, None, None, str(failure))
            raise
        finally:
            for used in packages:
                storage.remove(self.spark, f"{self.dataset.base}/{used.name}")

    # ---- extract ----

    @property
    def _resource_id(self) -> str:
        return f"{self.spec['identity']}.{self.res.destination}"

    def _read(self, reader: Reader) -> tuple[DataFrame, list[Column]]:
        """The source rows after its own filter; with `new_files`, only of files newer than the last load's."""
        options, observe = dict(self.res.options), []
        if options.get("new_files"):
            options["modified_after"] = ledger.stored_cursor(self.dataset, f"{self._resource_id}:files")
        df = reader(self.spark, self.spec["source_uri"], self.res.source, {**options, "with_rejects": True})
        if options.get("new_files"):
            df = df.withColumn("__modified", F.col("_metadata.file_modification_time"))
            observe.append(F.date_format(F.max("__modified"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("files"))
        if options.get("filter"):
            wanted = predicate(options["filter"])
            df = df.filter(wanted | rejects.rejected() if rejects.is_marked(df) else wanted)
        return df, observe

    def _new_rows(self, df: DataFrame) -> tuple[DataFrame, Observation, Column]:
        """New rows and, from the same pass, how many rows have no cursor and the next cursor.

        `new or NULL` still reaches the scan; the NULLs are counted and left out. A copy
        of the cursor feeds the observation, as the rules may drop or hash the column.
        """
        cursor = self.res.cursor
        key = F.col(f"`{cursor.key}`")
        last = ledger.stored_cursor(self.dataset, self._resource_id)
        keep = cursor_predicate(cursor, df.schema[cursor.key].dataType, last)
        nulls = Observation(f"nulls-{uuid.uuid4().hex[:8]}")
        bad = rejects.rejected() if rejects.is_marked(df) else F.lit(False)
        rows = df.filter(keep | key.isNull()).observe(nulls, F.count_if(key.isNull() & ~bad).alias("nulls"))
        pick = F.max if cursor.direction == "max" else F.min
        rows = rows.filter(key.isNotNull() | bad).withColumn("__cursor", F.when(~bad, key))  # a rejected row moves no cursor
        self._cursor_type = df.schema[cursor.key].dataType.simpleString()
        return rows, nulls, cursor_text(pick("__cursor"), df.schema[cursor.key].dataType).alias("cursor")

    def _limited(self, df: DataFrame) -> DataFrame:
        """The source limit. Where state is kept, whole files or whole ties from the stored cursor on, so
        that the state never passes an unread row; `row_order` then has no say in what is read first."""
        limit, cursor = self.res.options.get("limit"), self.res.cursor
        if not limit:
            return df
        if self.res.options.get("new_files"):
            return whole_ties(df, "__modified", limit)
        if cursor is None:
            return limited(df, (), limit)
        if cursor.is_backfill:
            return ordered(df, cursor, self.res.options.get("row_order"), [], limit)
        return whole_ties(df, "__cursor", limit, cursor.direction == "max", ledger.stored_cursor(self.dataset, self._resource_id))

    def _package(self, df: DataFrame, observe: list[Column]) -> TableState:
        """The rows as written files, which cuts the lineage: they are read by several plans."""
        res = self.res
        bucket = None
        if rejects.is_marked(df):
            bucket = F.when(rejects.rejected(), 1).otherwise(0)  # both parts in one pass
            if res.exclude or res.pseudonymize:
                df = df.withColumn(rejects.VALUE, F.lit(None).cast("string"))  # the text would show what the rules hide
        return self.dataset.stage(f"_packages/{uuid.uuid4().hex[:12]}", df, bucket, observe=observe, without=_HELPERS)

    def _without_repeats(self, rows: DataFrame, packages: list[TableState]) -> DataFrame:
        """One row per primary key, where children are split off later. The keys of the written package are
        counted; only rows whose key repeats are shuffled whole, and without any the package serves as it is."""
        res, keys = self.res, self.res.keys("primary_key")
        if not (_nested(rows.schema) and res.disposition == "merge" and res.strategy == "delete-insert" and keys):
            return rows
        named = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
        repeated = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).drop("__n")
        if repeated.isEmpty():
            return rows
        found = measured(repeated)
        firsts = dedup(with_keys(rows, found, keys), keys, res.config.get("dedup_sort_column"))
        package = self.dataset.stage(f"_packages/{uuid.uuid4().hex[:12]}", without_keys(rows, found, keys).unionByName(firsts))
        packages.append(package)
        return self.dataset.rows(package, package.paths)

    def _keep_rejected(self, package: TableState, paths: list[str], started: datetime) -> None:
        """Rejected rows go to a table beside the destination, published by the load's commit."""
        if not paths:
            return
        bad = self.dataset.rows(package, paths).select(
            F.lit(self.res.source).alias("resource"), F.col(rejects.REASON).alias("reason"), F.col(rejects.VALUE).alias("value"),
            F.col(rejects.FILE).alias("file"), F.lit(self.load_id).alias("_load_id"),
        )
        kept = self.dataset.append(rejects_table(self.res.destination), bad)
        self.apart.append(kept)
        self.trace.add("extract", f"{self.res.source}:rejects", started, kept.rows_written, kept.bytes_written)

    def _about(self, metrics: Mapping) -> dict:
        """What the commit says about this load. A backfill or a load without new rows keeps the state."""
        states: dict[str, dict] = {}
        if metrics.get("files"):
            states[f"{self._resource_id}:files"] = {"cursor": metrics["files"], "cursor_type": "timestamp"}
        cursor, seen = self.res.cursor, metrics.get("cursor")
        if cursor is not None and not cursor.is_backfill and seen is not None:
            last = ledger.stored_cursor(self.dataset, self._resource_id)
            furthest = seen if last is None else _later(seen, last, cursor.direction)
            states[self._resource_id] = {"cursor": furthest, "cursor_type": self._cursor_type}
        return {"load_id": self.load_id, "pipeline": self.spec["identity"], "state": states, "stream": self.progress, "also": self.apart}

    # ---- normalise ----

    def _row_keys(self) -> list[str]:
        given = list(self.res.options.get("row_id_keys") or [])
        return [snake_case(k) for k in given or (self.res.keys("primary_key") if self.res.disposition == "merge" else [])]

    def _normalized(self, rows: DataFrame, empty: bool = False) -> dict[str, DataFrame]:
        """Flat tables with row and load ids; the root comes first."""
        root = snake_case(self.res.destination)
        if self.res.strategy == "scd2":
            return {root: flatten(rows)}  # its row id, of content and start, is added by the merge
        keys = self._row_keys()
        if keys or empty:
            # a merged key keeps its id from load to load; an appended row is a new one each time
            stable = keys and self.res.disposition == "merge"
            identified = with_row_id(snake_columns(rows), "" if stable else self.load_id, keys)
        else:
            # the place in the package's files is unique and does not change: no shuffle
            place = F.concat_ws("|", F.lit(self.load_id), "_metadata.file_name", F.col("_metadata.row_index").cast("string"))
            identified = snake_columns(rows.withColumn("_row_id", F.sha2(place, 256)))
        tables = relational(identified, root) if _nested(rows.schema) else {root: flatten(identified)}
        return {name: with_load_id(df, self.load_id) for name, df in tables.items()}

    # ---- load ----

    def _is_direct(self, df: DataFrame) -> bool:
        plain = self.res.disposition in ("append", "replace") and not self.external and not rejects.is_marked(df)
        return plain and bool(self._row_keys()) and not _nested(df.schema) and not self.res.options.get("detect_timestamps")

    def _write_direct(self, tables: dict[str, DataFrame], observe: list[Column]) -> tuple[dict[str, int], Mapping]:
        (name, df), = tables.items()
        if self.res.disposition == "append":
            change = self.dataset.append(name, df, observe, without=_HELPERS)
            self.dataset.commit([change], **self._about(change.metrics))
        else:
            change = replace_tables(self.dataset, tables, self.res.strategy, observe=observe, without=_HELPERS, about=self._about)[name]
        return {name: change.rows_written}, change.metrics

    def _write(self, tables: dict[str, DataFrame], about: dict) -> dict[str, int]:
        if self.external:
            return self._write_external(tables, about)
        res, dataset = self.res, self.dataset
        root, *children = tables
        if res.disposition == "replace":
            staged = replace_tables(dataset, tables, res.strategy, **about)
            return {n: s.rows_written for n, s in staged.items()}
        if res.disposition == "append":
            changes = [dataset.append(n, df) for n, df in tables.items()]
            dataset.commit(changes, **about)
            return {c.name: c.rows_written for c in changes}
        buckets = int(res.options.get("buckets", 1))
        if res.strategy == "scd2":
            change = dataset.merge_scd2(root, tables[root], self._boundary(), res.scd2(), buckets)
            dataset.commit([change], **about)
            return {root: change.rows_written}
        pk, mk = ([snake_case(k) for k in res.keys(name)] for name in ("primary_key", "merge_key"))
        # with both keys a row can meet its match in any bucket, so only the files that hold one tell what is
        # rewritten; with a primary key its hash, the row id, is the scope, so that child rows share their root's bucket
        scope = [] if (pk and mk) else (["_row_id"] if pk else mk)
        before = dataset.table(root)
        if before is not None:
            _same_key_types(before.schema, tables[root].schema, pk)
        change = dataset.merge(root, tables[root], self._merge_function(), scope, buckets, match=[k for k in (pk, mk) if k])
        changes = [change] + _child_changes(dataset, before, change, tables, children, buckets if pk and not mk else 1, res.strategy)
        dataset.commit(changes, **about)
        return {c.name: c.rows_written for c in changes}

    def _boundary(self) -> Column:
        return boundary_time(self.run_time, bool(self.res.config.get("use_boundary_timestamp", False)))

    def _merge_function(self) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
        config = self.res.config
        hard_delete = snake_case(config["hard_delete_column"]) if config.get("hard_delete_column") else None
        pk, mk = ([snake_case(k) for k in self.res.keys(name)] for name in ("primary_key", "merge_key"))
        sort = {snake_case(k): v for k, v in (config.get("dedup_sort_column") or {}).items()}
        if self.res.strategy == "scd2":
            return lambda old, new: scd2(old, new, self._boundary(), self.res.scd2())
        if self.res.strategy == "upsert":
            return lambda old, new: merges.upsert(old, new, pk, hard_delete, measure=True)
        return lambda old, new: merges.delete_insert(old, new, pk, mk, hard_delete, sort, measure=True)

    def _write_external(self, tables: dict[str, DataFrame], about: dict) -> dict[str, int]:
        """Tables of another system: appended, replaced, or merged by computing the new state here.

        The ledger in the state folder knows which tables this job has created; a first
        merge creates its table and fails when one is already there.
        """
        uri, name, disposition = self.spec["destination_uri"], dataset_name(self.spec), self.res.disposition
        if disposition == "merge" and len(tables) > 1:
            raise ValueError("nested rows merge only into folders")
        changes = []
        for table, df in tables.items():
            known = self.dataset.table(table) is not None
            if disposition == "append":
                external.write_external(df, uri, name, table, "append")
            elif disposition == "replace" and self.res.strategy == "truncate-and-insert":
                external.write_external(df, uri, name, table, "overwrite")
            elif disposition == "replace":
                external.replace_staged(df, uri, name, table)
            elif known:
                old = external.read_external(self.spark, uri, name, table)
                external.replace_staged(self._merge_function()(old, df), uri, name, table)
            else:
                external.write_external(self._merge_function()(None, df), uri, name, table, "errorifexists")
            changes.append(TableState(table, df.schema))
        self.dataset.commit(changes, **about)
        return {c.name: c.rows_written for c in changes}


def _same_key_types(old: T.StructType, new: T.StructType, keys: list[str]) -> None:
    """Row ids and buckets follow the text of the key, so its type must stay (integers may widen)."""
    for k in keys:
        a, b = old[k].dataType, new[k].dataType
        if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
            raise ValueError(f"key column {k} changed from {a.simpleString()} to {b.simpleString()}; replace the table instead")


def _child_changes(
    dataset: Dataset, before: TableState | None, after: TableState, tables: dict[str, DataFrame], children: list[str], buckets: int, strategy: str
) -> list[TableState]:
    """Child tables follow their root: children of replaced or removed roots go, those of inserted roots come.

    Stored child tables follow too when the batch has no such list: a delete-insert replaces
    rows whole, so their old lists go; an upsert leaves the lists of rows that live on.
    """
    absent = [n for n in dataset.child_tables(after.name) if n not in children]
    if not children and not absent:
        return []
    incoming = tables[after.name].select("_row_id")
    written = dataset.rows(after, dataset.difference(after.paths, before.paths if before is not None else ())).select("_row_id")
    removed, deleted = incoming, None
    if before is not None:
        dropped = dataset.rows(before, dataset.difference(before.paths, after.paths)).select("_row_id")
        deleted = without_keys(dropped, key_set(written, ["_row_id"]), ["_row_id"])
        removed = incoming.union(deleted)
    touch = removed.withColumnRenamed("_row_id", "_root_id")

    def follow(old: DataFrame | None, new: DataFrame) -> DataFrame:
        live = with_keys(new, key_set(written, ["_row_id"]), ["_root_id"])
        return live if old is None else merges.merge_children(old, live, removed)

    def leave(old: DataFrame, new: DataFrame) -> DataFrame:
        return merges.merge_children(old, new, deleted if strategy == "upsert" else removed)

    scope = ["_root_id"] if buckets > 1 else []
    changes = [dataset.merge(n, tables[n], follow, scope, buckets, touch=touch, match=[["_root_id"]]) for n in children]
    if before is not None:
        changes += [dataset.merge(n, dataset.rows(dataset.table(n), []), leave, scope, buckets, touch=touch, match=[["_root_id"]]) for n in absent]
    return changes
