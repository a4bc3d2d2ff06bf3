"""Operators on small inputs, with properties checked against plain Python."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import one_row_per_key
from sluiceway.functions.names import snake_case, snake_columns
from sluiceway.functions.text import canonical_text
from sluiceway.operators import merge as merges, observe
from sluiceway.operators.dedup import dedup
from sluiceway.operators.incremental import Cursor, new_rows
from sluiceway.operators.normalize import detect_iso_timestamps, evolve_union, flatten, relational, wider_type, with_row_id
from sluiceway.operators.rules import apply_rules, pseudonymize
from sluiceway.operators.scd2 import Scd2, boundary_time, scd2

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
KV = "k int, v int"


def kv(spark, rows):
    return spark.createDataFrame(rows, KV)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


keys = st.one_of(st.none(), st.integers(0, 4))
pairs = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=12)


def unique(rows):
    return list({k: (k, v) for k, v in rows}.values())


@QUICK
@given(pairs, pairs)
def test_upsert_matches_a_dict_and_is_idempotent(spark, old, new):
    old, new = unique(old), unique(new)
    once = merges.upsert(kv(spark, old), kv(spark, new), "k")
    assert values(once) == sorted({**dict(old), **dict(new)}.items(), key=str)
    assert values(merges.upsert(once, kv(spark, new), "k")) == values(once)


@QUICK
@given(pairs, pairs)
def test_delete_insert_has_unique_keys(spark, old, new):
    merged = merges.delete_insert(kv(spark, unique(old)), kv(spark, new), "k", dedup_sort={"v": "desc"})
    expected = dict(unique(old))
    best = {}
    for k, v in new:
        best[k] = max(v, best.get(k, v))
    expected.update(best)
    assert values(merged) == sorted(expected.items(), key=str)


@QUICK
@given(pairs, pairs)
def test_merge_key_replaces_whole_groups(spark, old, new):
    merged = merges.delete_insert(kv(spark, old), kv(spark, new), merge_key="k")
    arrived = {k for k, _ in new}
    assert values(merged) == sorted([r for r in old if r[0] not in arrived] + new, key=str)


@QUICK
@given(st.lists(st.lists(st.tuples(keys, st.integers(0, 2)), max_size=6), min_size=1, max_size=3))
def test_type_two_active_rows_equal_the_snapshot(spark, days):
    state = None
    for i, rows in enumerate(days):
        state = scd2(state, kv(spark, rows), boundary_time(f"2024-01-0{i + 1}"), Scd2(active_until=None))
        state = spark.createDataFrame(state.collect(), state.schema)
        active = state.filter("valid_to is null").select("k", "v")
        assert values(active) == sorted(set(rows), key=str)
    versions = {}
    for r in state.collect():
        versions.setdefault((r.k, r.v), []).append((r.valid_from, r.valid_to or datetime.max))
    for spans in versions.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


@QUICK
@given(st.lists(st.integers(0, 30), max_size=15), st.lists(st.integers(0, 30), min_size=1, max_size=3))
def test_slices_equal_one_full_load(spark, cursors, cuts):
    data = spark.createDataFrame([(c,) for c in cursors], "c int")
    seen, last = [], None
    for cut in sorted(cuts) + [31]:
        got = [r.c for r in new_rows(data.filter(F.col("c") < cut), Cursor("c"), last).collect()]
        seen += got
        last = max(got) if got else last
    assert sorted(seen) == sorted(cursors)


def test_null_keys_match_null_safely(spark):
    merged = merges.delete_insert(kv(spark, [(None, 1), (1, 1)]), kv(spark, [(None, 2)]), "k")
    assert values(merged) == [(1, 1), (None, 2)]


def test_flagged_rows_delete_and_unknown_flagged_rows_do_nothing(spark):
    incoming = spark.createDataFrame([(1, 9, True), (2, 9, None), (7, 9, True)], KV + ", gone boolean")
    for merged in (merges.delete_insert(kv(spark, [(1, 1), (2, 1), (3, 1)]), incoming, "k", hard_delete="gone"),
                   merges.upsert(kv(spark, [(1, 1), (2, 1), (3, 1)]), incoming, "k", "gone")):
        assert values(merged.select("k", "v")) == [(2, 9), (3, 1)]


def test_upsert_refuses_a_repeated_key_and_keeps_missing_columns(spark):
    with pytest.raises(Exception, match="more than one row for key"):
        merges.upsert(kv(spark, [(1, 1)]), kv(spark, [(1, 2), (1, 3)]), "k").collect()
    target = spark.createDataFrame([(1, 1, "kept")], KV + ", note string")
    assert values(merges.upsert(target, kv(spark, [(1, 5), (2, 6)]), "k")) == [(1, 5, "kept"), (2, 6, None)]


def test_dedup_sorts_nulls_last(spark):
    rows = kv(spark, [(1, None), (1, 3), (1, 2), (2, None)])
    assert values(dedup(rows, "k", {"v": "asc"})) == [(1, 2), (2, None)]
    assert values(dedup(rows, "k", {"v": "desc"})) == [(1, 3), (2, None)]
    with pytest.raises(ValueError):
        dedup(rows, "k", {"v": "down"})


def test_type_two_natural_key_wants_one_row_per_key(spark):
    with pytest.raises(Exception, match="more than one row for key"):
        scd2(None, kv(spark, [(1, 1), (1, 2)]), boundary_time("2024-01-01"), Scd2(natural_key="k")).collect()
    with pytest.raises(ValueError, match="only one of"):
        Scd2(natural_key="k", partition_key="v")
    with pytest.raises(ValueError, match="exactly two"):
        Scd2(columns=["from"])


def test_type_two_partition_scope_with_a_hot_partition(spark):
    """Many keys of one partition: scope marks must not multiply rows."""
    rows = spark.range(0, 4000, 1, 32).select(F.col("id").cast("int").alias("k"), F.lit("p").alias("part"))
    day = scd2(None, rows, boundary_time("2024-01-01"), Scd2(partition_key="part"))
    again = scd2(day, rows.filter("k >= 10"), boundary_time("2024-01-02"), Scd2(partition_key="part"))
    assert again.count() == 4000
    assert again.filter("valid_to = timestamp_ntz'2024-01-02'").count() == 10


def test_boundary_is_floored_to_the_minute(spark):
    row = spark.range(1).select(boundary_time("2024-05-06 07:08:09.5", True).alias("t")).first()
    assert row.t == datetime(2024, 5, 6, 7, 8)


def test_pseudonym_text(spark):
    row = spark.range(1).select(
        canonical_text(F.lit(True), T.BooleanType()).alias("b"),
        canonical_text(F.lit("2024-01-02 03:04:05.5").cast("timestamp_ntz"), T.TimestampNTZType()).alias("frac"),
        canonical_text(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"), T.TimestampNTZType()).alias("whole"),
        canonical_text(F.lit(date(2024, 1, 2)), T.DateType()).alias("d")).first()
    assert row[:] == ("True", "2024-01-02 03:04:05.500000", "2024-01-02 03:04:05", "2024-01-02")


def test_rules(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    row = apply_rules(df, ["z", "nope"], ["x", "y", "z", "nope"], "salt").first()
    assert row.asDict() == {"x": hashlib.sha256(b"asalt").hexdigest(), "y": None}
    with pytest.raises(ValueError, match="salt"):
        pseudonymize(df, ["x"], "")


def test_cursor_settings():
    with pytest.raises(ValueError, match="incremental_key"):
        Cursor(" ")
    with pytest.raises(ValueError, match="boundary_mode"):
        Cursor("k", boundary="closed")


def test_cursor_bounds_zero_and_dates(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (None,)], "k int")
    assert values(new_rows(rows, Cursor("k", end=0, boundary="end"))) == [(0,)]
    assert values(new_rows(rows, Cursor("k"), last=0)) == [(1,), (2,)]
    days = spark.createDataFrame([(date(2024, 1, i),) for i in (1, 2, 3)], "d date")
    assert days.transform(lambda d: new_rows(d, Cursor("d", lag=1, boundary="start"), last="2024-01-03")).count() == 2
    assert new_rows(days, Cursor("d", start=date(2024, 1, 3), boundary="start", lag=9), last="2024-01-03").count() == 1


@pytest.mark.parametrize("name, expected", [
    ("ResidenceType", "residence_type"), ("residence type", "residence_type"), ("ID", "id"), ("HTTPCode", "http_code"), ("2nd", "_2nd"),
    ("avg_glucose_level", "avg_glucose_level"), ("a.b-c", "a_b_c"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_name_collisions_are_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        snake_columns(spark.createDataFrame([(1, 2)], "`Ab` int, ab_ int").toDF("fooBar", "foo_bar"))
    nested = spark.range(1).select(F.struct(F.lit(1).alias("b")).alias("a"), F.lit(2).alias("a__b"))
    with pytest.raises(ValueError, match="collide"):
        flatten(nested)


def test_widening(spark):
    assert wider_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider_type(T.LongType(), T.StringType()) == T.StringType()
    assert wider_type(T.LongType(), T.FloatType()) == T.DoubleType()
    with pytest.raises(ValueError, match="no common type"):
        wider_type(T.DateType(), T.LongType())
    both = evolve_union(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2.5, "n")], "a double, b string"))
    assert values(both) == [(1.0, None), (2.5, "n")]


def test_iso_detection_needs_every_value(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "2024-01-02", None), ("2024-01-02 03:04:05.123+02:00", "soon", "2024-01-03", None)],
        "good string, bad string, day string, empty string")
    types = dict(detect_iso_timestamps(df).dtypes)
    assert types == {"good": "timestamp", "bad": "string", "day": "string", "empty": "string"}


def test_nested_rows_become_related_tables(spark):
    df = spark.read.json(spark.sparkContext.parallelize(
        ['{"id": 1, "Home": {"City": "x"}, "tags": ["a", "b"], "lines": [{"n": 1, "parts": [{"p": 5}]}]}', '{"id": 2, "tags": []}']))
    tables = relational(with_row_id(df, keys=["id"]), "doc")
    assert set(tables) == {"doc", "doc__tags", "doc__lines", "doc__lines__parts"}
    assert values(tables["doc"].select("home__city", "id")) == [("x", 1), (None, 2)]
    assert [r[:] for r in tables["doc__tags"].select("value", "_list_idx").collect()] == [("a", 0), ("b", 1)]
    part, root = tables["doc__lines__parts"].first(), tables["doc"].filter("id = 1").first()
    assert part.p == 5 and part._root_id == root._row_id and part._parent_id == tables["doc__lines"].first()._row_id


def test_maps_become_child_tables(spark):
    df = spark.range(1).select("id", F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    child = relational(with_row_id(df, keys=["id"]), "t")["t__m"]
    assert [(r.key, r.value) for r in child.collect()] == [("a", 1)]


def test_system_names_are_whole_names(spark):
    """A user's table whose name only holds the state table's name is a table like others."""
    rows = [("_pipeline_state", None), ("Resources", None), ("sales_pipeline_state", None), ("sales", "_pipeline_state"), ("sales", "my_pipeline_state_2"), ("sales", None)]
    df = spark.createDataFrame(rows, "name string, label string")
    assert sorted(r.name for r in observe.skip_system(df).collect()) == ["sales", "sales", "sales", "sales_pipeline_state"]
    assert sorted((r.name, r.label or "") for r in observe.skip_system(df, "name", "label").collect()) == [("sales", ""), ("sales", "my_pipeline_state_2"), ("sales_pipeline_state", "")]


def test_unique_keys_are_checked_apart_from_the_rows(spark, tmp_path):
    """Keys are counted by a hash aggregate; the rows are not shuffled, sorted or aggregated, and a repeated key fails."""
    rows = spark.range(1000).selectExpr("id % 999 as k", "if(id % 5 = 0, null, cast(id as string)) as t", "array(id) as list", "map('a', id) as m")
    rows.where("k > 0").write.parquet(f"{tmp_path}/good")
    rows.write.parquet(f"{tmp_path}/bad")
    good = one_row_per_key(spark.read.parquet(f"{tmp_path}/good"), ["k"], "upsert")
    assert good.count() == 998 and good.columns == rows.columns
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    main = plan.split("Subqueries")[0] if "Subqueries" in plan else plan
    assert "first(" not in main and "struct" not in main.split("subquery")[0]
    bad = spark.read.parquet(f"{tmp_path}/bad")
    with pytest.raises(Exception, match=r'more than one row for key \(k\) = \{"k":0\}'):
        one_row_per_key(bad, ["k"], "upsert").collect()
    with pytest.raises(Exception, match="more than one row for key"):
        one_row_per_key(bad, ["k"], "upsert").select("t").write.parquet(f"{tmp_path}/out")
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "`k.x` string, v string")
    with pytest.raises(Exception, match="more than one row"):
        one_row_per_key(nulls, ["k.x"], "upsert").collect()
    assert one_row_per_key(nulls.limit(0), ["k.x"], "upsert").count() == 0
