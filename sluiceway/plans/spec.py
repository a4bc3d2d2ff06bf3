"""A job specification: a plain dict, read once into manifest rows and settings."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.keys import key_list
from sluiceway.functions.names import snake_case
from sluiceway.sinks.storage import small_frame
from sluiceway.sources.predicates import operators_on
from sluiceway.operators.incremental import Cursor
from sluiceway.operators.scd2 import ACTIVE_UNTIL, VALIDITY_COLUMNS, Scd2
from sluiceway.plans.manifest import CONFIG_BLOCKS, MANIFEST_SCHEMA

_JOB_KEYS = {"identity", "source_uri", "destination_uri", "dataset_name", "resources", "salt", "state_folder"}
_RESOURCE_KEYS = {
    "source_table_name", "destination_table_name", "column_rules", "incremental_config", "write_disposition_config",
    "source_options",
}
_RULE_KEYS = {"exclude_columns", "pseudonymizing_columns"}
_INCREMENTAL_KEYS = {"incremental_key", "start_position", "end_position", "lag_window", "boundary_mode", "direction"}
_OPTION_KEYS = {
    "batch_size", "batch_timeout", "start_from", "filter", "limit", "row_order", "new_files", "schema", "buckets", "row_id_keys", "split_column",
    "bounds", "splits", "payload", "detect_timestamps", "resume", "follow",
}


def _known(part: str, given: Mapping, allowed: set[str]) -> None:
    extra = sorted(set(given) - allowed)
    if extra:
        raise ValueError(f"unknown keys in {part}: {', '.join(extra)}")


@dataclass(frozen=True)
class Resource:
    """Settings of one resource, after the manifest rules have accepted it."""

    source: str
    destination: str
    exclude: tuple[str, ...]
    pseudonymize: tuple[str, ...]
    cursor: Cursor | None
    disposition: str
    strategy: str | None
    config: Mapping = field(default_factory=dict)
    options: Mapping = field(default_factory=dict)

    def keys(self, name: str) -> list[str]:
        return key_list(self.config.get(name))

    def scd2(self) -> Scd2:
        return Scd2(
            natural_key=[snake_case(k) for k in self.keys("natural_merge_key")],
            partition_key=[snake_case(k) for k in self.keys("partition_merge_key")],
            columns=tuple(self.config.get("validity_column_names") or VALIDITY_COLUMNS),
            active_until=self.config.get("active_record_timestamp", ACTIVE_UNTIL),
            hash_column="_row_id",
        )


def manifest_rows(spark: SparkSession, spec: Mapping) -> DataFrame:
    """One row per resource of the specification."""
    _known("job", spec, _JOB_KEYS)
    resources = list(spec.get("resources") or [])
    if not resources:
        raise ValueError("At least one resource must be provided")
    rows = []
    for i, res in enumerate(resources):
        _known("resource", res, _RESOURCE_KEYS)
        rules = res.get("column_rules") or {}
        inc = res.get("incremental_config") or {}
        wd = res.get("write_disposition_config") or {}
        opts = res.get("source_options") or {}
        _known("column_rules", rules, _RULE_KEYS)
        _known("incremental_config", inc, _INCREMENTAL_KEYS)
        _known("write_disposition_config", wd, {"type", "strategy", "config"})
        _known("source_options", opts, _OPTION_KEYS)
        config = wd.get("config")
        rows.append((
            spec.get("identity"), spec.get("source_uri"), spec.get("destination_uri"), spec.get("dataset_name"), i,
            res.get("source_table_name"), res.get("destination_table_name"), list(rules.get("exclude_columns", [])),
            list(rules.get("pseudonymizing_columns", [])), inc.get("incremental_key"), _text(inc.get("start_position")),
            _text(inc.get("end_position")), _number(inc.get("lag_window")), inc.get("boundary_mode"),
            operators_on(opts.get("filter") or {}, inc.get("incremental_key")), wd.get("type"),
            wd.get("strategy"), None if config is None else json.dumps(config), opts.get("start_from"),
            opts.get("batch_size"), opts.get("batch_timeout"),
        ))
    return small_frame(spark, rows, MANIFEST_SCHEMA)


def _text(value) -> str | None:
    return None if value is None else str(value)


def _number(value) -> float | None:
    return None if value is None else float(value)


def resources(spec: Mapping) -> list[Resource]:
    """The settings of every resource, with defaults; config may be flat or nested per strategy."""
    out = []
    for res in spec["resources"]:
        rules = res.get("column_rules") or {}
        inc = res.get("incremental_config")
        wd = res.get("write_disposition_config") or {}
        kind = wd.get("type") or "replace"
        strategy = wd.get("strategy") or {"replace": "truncate-and-insert", "merge": "delete-insert"}.get(kind)
        config = wd.get("config") or {}
        config = config.get(CONFIG_BLOCKS.get(strategy, ""), config)
        cursor = None
        if inc:
            cursor = Cursor(
                inc["incremental_key"], inc.get("start_position"), inc.get("end_position"), inc.get("lag_window"),
                inc.get("boundary_mode"), inc.get("direction", "max"),
            )
        out.append(Resource(
            res["source_table_name"], res.get("destination_table_name") or res["source_table_name"],
            tuple(rules.get("exclude_columns", ())), tuple(rules.get("pseudonymizing_columns", ())), cursor, kind,
            strategy, config, res.get("source_options") or {},
        ))
    return out
