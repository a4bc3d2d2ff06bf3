"""Checks and defaults of job specifications, as column expressions over a manifest.

A manifest has one row per job and resource; a single job is the small case of the
same plan. Every rule yields an error text or NULL; `check` gathers them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.uri import uri_error, with_scheme, without_scheme

MANIFEST_SCHEMA = (
    "identity string, source_uri string, destination_uri string, dataset_name string, resource_no int, "
    "source_table_name string, destination_table_name string, exclude_columns array<string>, "
    "pseudonymizing_columns array<string>, incremental_key string, start_position string, end_position string, "
    "lag_window double, boundary_mode string, filter_operators array<string>, wd_type string, wd_strategy string, "
    "wd_config string, start_from string, batch_size int, batch_timeout int"
)

# Accepted names.
WD_TYPES = ("append", "replace", "merge")
REPLACE_STRATEGIES = ("truncate-and-insert", "insert-from-staging", "staging-optimized")
MERGE_STRATEGIES = ("delete-insert", "scd2", "upsert")
BOUNDARIES = ("start-end", "start", "end", "between")
CONFIG_BLOCKS = {"delete-insert": "delete_insert_config", "scd2": "scd2_config", "upsert": "upsert_config"}
CONFIG_KEYS = {
    "delete-insert": ("primary_key", "merge_key", "hard_delete_column", "dedup_sort_column"),
    "scd2": ("natural_merge_key", "partition_merge_key", "validity_column_names", "active_record_timestamp",
             "use_boundary_timestamp"),
    "upsert": ("primary_key", "hard_delete_column"),
}
NEEDED = (
    ("identity", "identity: Field must be provided"),
    ("source_uri", "source_uri: URI must be provided"),
    ("destination_uri", "destination_uri: URI must be provided"),
    ("source_table_name", "source_table_name: Field must be provided"),
)


def _blank(name: str) -> str:
    return f"coalesce(trim({name}), '') = ''"


def _texts(names: Iterable[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _rule(condition: str, message: str | Column) -> Column:
    """The message where the condition holds, else NULL."""
    return F.when(F.expr(condition), F.lit(message) if isinstance(message, str) else message)


def _listed(text: str, items: str) -> Column:
    return F.concat(F.lit(text), F.expr(f"array_join(array_sort({items}), ', ')"))


EFFECTIVE_TYPE = "coalesce(wd_type, 'replace')"
EFFECTIVE_STRATEGY = (
    f"coalesce(wd_strategy, case {EFFECTIVE_TYPE} when 'replace' then '{REPLACE_STRATEGIES[0]}' when 'merge' then '{MERGE_STRATEGIES[0]}' end)"
)
_NO_TEXTS = "cast(array() as array<string>)"


def _per_strategy(values: Mapping[str, str]) -> str:
    return "case __strategy " + " ".join(f"when '{s}' then {v}" for s, v in values.items()) + " end"


def _keys(name: str) -> Column:
    """A key given as text or list, as a list; NULL when absent or empty."""
    many, one = f"try_variant_get(__doc, '$.{name}', 'array<string>')", f"try_variant_get(__doc, '$.{name}', 'string')"
    return F.expr(f"nullif(coalesce({many}, case when {one} is not null then array({one}) end), {_NO_TEXTS})")


def with_config(manifest: DataFrame) -> DataFrame:
    """Add the effective disposition and its parsed settings, each computed once.

    Settings stand in the strategy's nested block, else in the flat document.
    """
    block_name = _per_strategy({s: f"'{b}'" for s, b in CONFIG_BLOCKS.items()})
    allowed = _per_strategy({s: f"array({_texts(keys)})" for s, keys in CONFIG_KEYS.items()})
    rows = manifest.withColumns({"__kind": F.expr(EFFECTIVE_TYPE), "__strategy": F.expr(EFFECTIVE_STRATEGY)})
    rows = rows.withColumns({
        "__block_name": F.expr(f"case when __kind = 'merge' then {block_name} end"),
        "__allowed": F.expr(allowed), "__blocks": F.expr(f"array({_texts(CONFIG_BLOCKS.values())})"),
        "__top": F.expr("json_object_keys(wd_config)"),
    })
    rows = rows.withColumn("__nested", F.expr(
        "case when array_contains(__top, __block_name) then get_json_object(wd_config, concat('$.', __block_name)) end"))
    rows = rows.withColumn("__block", F.expr("case when __kind = 'merge' then coalesce(__nested, wd_config) end"))
    rows = rows.withColumn("__doc", F.expr("try_parse_json(__block)"))
    keys = ("primary_key", "merge_key", "natural_merge_key", "partition_merge_key", "validity_column_names")
    return rows.withColumns({f"__{k}": _keys(k) for k in keys})


def required_rules() -> list[Column]:
    return [_rule(_blank(name), text) for name, text in NEEDED]


def uri_rules() -> list[Column]:
    out = []
    for name in ("source_uri", "destination_uri"):
        error = uri_error(name, name.removesuffix("_uri"))
        out.append(F.when(F.expr(f"not ({_blank(name)})") & error.isNotNull(), F.concat(F.lit(f"{name}: "), error)))
    return out


def disposition_rules() -> list[Column]:
    merge, scd2 = "__kind = 'merge'", "__kind = 'merge' and __strategy = 'scd2'"
    delete_insert, upsert = "__kind = 'merge' and __strategy = 'delete-insert'", "__kind = 'merge' and __strategy = 'upsert'"
    used = "array_except(array_except(json_object_keys(__block), __allowed), __blocks)"
    stray = f"case when __nested is not null then array_except(__top, __blocks) else {_NO_TEXTS} end"
    unknown = f"concat({used}, {stray})"
    foreign = "array_remove(array_intersect(__top, __blocks), __block_name)"
    needed = (f"array_union(coalesce(__primary_key, {_NO_TEXTS}), array_union(coalesce(__merge_key, {_NO_TEXTS}), "
              f"coalesce(__natural_merge_key, __partition_merge_key, {_NO_TEXTS})))")
    lost = f"array_intersect({needed}, coalesce(exclude_columns, {_NO_TEXTS}))"
    sorts = "map_values(from_json(get_json_object(__block, '$.dedup_sort_column'), 'map<string,string>'))"
    strategy_name = F.concat(F.lit(" merge_strategy is '"), F.col("__strategy"), F.lit("'"))
    return [
        _rule(f"__kind not in ({_texts(WD_TYPES)})", F.concat(F.lit("Unsupported write disposition type: "), F.col("__kind"))),
        _rule("__kind = 'append' and (wd_strategy is not null or wd_config is not null)",
              "No strategy or config is accepted when write_disposition type is 'append'"),
        _rule("__kind = 'replace' and wd_config is not null", "Config is not accepted when write_disposition is 'replace'"),
        _rule(f"__kind = 'replace' and __strategy not in ({_texts(REPLACE_STRATEGIES)})", "Invalid replace strategy"),
        _rule(f"{merge} and __strategy not in ({_texts(MERGE_STRATEGIES)})", "Invalid merge strategy"),
        _rule(f"{merge} and wd_config is not null and __top is null", "config must be a JSON object"),
        _rule(f"{merge} and __block_name is not null and wd_config is null",
              F.concat(F.col("__block_name"), F.lit(" is required when"), strategy_name)),
        _rule(f"{merge} and size({foreign}) > 0", F.concat(F.lit("Only "), F.col("__block_name"), F.lit(" is accepted when"), strategy_name)),
        _rule(f"{merge} and size({unknown}) > 0", _listed("Unknown config keys: ", unknown)),
        _rule(f"{delete_insert} and __top is not null and __primary_key is null and __merge_key is null",
              "At least one of 'primary' or 'merge' key(s) must be provided for delete-insert strategy"),
        _rule(f"{upsert} and __top is not null and (__primary_key is null or exists(__primary_key, k -> coalesce(trim(k), '') = ''))",
              "Primary key must be provided"),
        _rule(f"{scd2} and __natural_merge_key is not null and __partition_merge_key is not null",
              "Only one of 'natural' or 'partition' merge key(s) must be provided for scd2 strategy"),
        _rule(f"{scd2} and size(__validity_column_names) != 2", "Validity column names must contain exactly two strings"),
        _rule(f"{delete_insert} and exists({sorts}, d -> d not in ('asc', 'desc'))", "dedup_sort_column must be 'asc' or 'desc'"),
        _rule(f"{merge} and size({lost}) > 0", _listed("Key columns cannot be excluded: ", lost)),
    ]


def source_rules() -> list[Column]:
    stamped = "start_from like 'timestamp:%'"
    used = "case when end_position is null then array('$gte') else array('$gte', '$lt') end"
    clash = f"array_intersect(coalesce(filter_operators, {_NO_TEXTS}), {used})"
    return [
        _rule(f"incremental_key is not null and {_blank('incremental_key')}", "incremental_key: Field must be provided"),
        _rule(f"boundary_mode not in ({_texts(BOUNDARIES)})", "Invalid boundary mode"),
        _rule(f"{stamped} and not regexp(start_from, '^timestamp:[+-]?[0-9]+$')",
              "Invalid format for timestamp. Expected 'timestamp:<epoch_ms>'"),
        _rule(f"start_from != '' and not {stamped} and start_from not in ('earliest', 'latest')",
              "start_from must be 'earliest', 'latest', or 'timestamp:<epoch_ms>'"),
        _rule(f"incremental_key is not null and size({clash}) > 0", _listed("Filter operators already used by the cursor: ", clash)),
    ]


def with_routes(manifest: DataFrame) -> DataFrame:
    """Add what is known about both schemes and whether each has a route."""
    rows = with_scheme(with_scheme(manifest, "source_uri", "source"), "destination_uri", "destination")
    return rows.withColumns({
        "source_routable": F.coalesce("source_is_source", F.lit(False)),
        "destination_routable": F.coalesce("destination_is_destination", F.lit(False)),
    })


def _tidy(rows: DataFrame) -> DataFrame:
    return without_scheme(without_scheme(rows, "source"), "destination")


def route_rules() -> list[Column]:
    return [
        _rule(f"not ({_blank(f'{side}_uri')}) and not {side}_routable",
              F.concat(F.lit(f"Invalid {side} URI scheme: "), F.col(f"{side}_scheme")))
        for side in ("source", "destination")
    ]


def _with_errors(rows: DataFrame, rules: list[Column]) -> DataFrame:
    checked = rows.withColumn("errors", F.array_compact(F.array(*rules)))
    return _tidy(checked.drop(*[c for c in rows.columns if c.startswith("__")]))


def check(manifest: DataFrame) -> DataFrame:
    """The manifest with `errors`, an empty list for a good row."""
    rules = required_rules() + uri_rules() + route_rules() + disposition_rules() + source_rules()
    return _with_errors(with_config(with_routes(manifest)), rules)


def with_errors(manifest: DataFrame, rules: list[Column]) -> DataFrame:
    """The manifest with the errors of some rules only."""
    return _with_errors(with_config(with_routes(manifest)), rules)


def with_defaults(manifest: DataFrame) -> DataFrame:
    """Fill the destination table, dataset, disposition and strategy where none is given."""
    rows = with_routes(manifest)
    filled = rows.withColumns({
        "destination_table_name": F.coalesce("destination_table_name", "source_table_name"),
        "dataset_name": F.expr(f"case when {_blank('dataset_name')} then coalesce(destination_default_dataset, '') else dataset_name end"),
        "wd_strategy": F.expr(EFFECTIVE_STRATEGY),
        "wd_type": F.expr(EFFECTIVE_TYPE),
        "start_from": F.coalesce("start_from", F.lit("earliest")),
        "batch_size": F.coalesce("batch_size", F.lit(100)),
        "batch_timeout": F.coalesce("batch_timeout", F.lit(5)),
    })
    return _tidy(filled)
