"""Upsert by order: for each key the newest row wins, and newer deletes stay deleted.

The result is the same in whatever order and batches the rows come. That needs a memory besides
the table, one narrow row for a key that has one: the order of its newest delete (so that an
older row cannot bring the key back), and the order of columns whose value does not come from
the key's newest row (so that a partial row leaves them, and an older row can still fill them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.keys import on_keys, sortable
from sluiceway.operators.dedup import dedup
from sluiceway.operators.merge import delete_flag
from sluiceway.operators.normalize import evolve_union

#: Columns of the memory, besides the key; ALIVE marks keys that have a row in the table.
DELETED, SET, ALIVE = "_deleted", "_set", "_alive"


def newest_wins(
    rows: DataFrame, old: DataFrame | None, memory: DataFrame | None, keys: Sequence[str], newest: Mapping[str, str], hard_delete: str | None = None
) -> DataFrame:
    """Every key of the rows, the table's rows and the memory with its new columns, and what to remember of it.

    `newest` is {column: asc|desc}; every row needs these columns. Columns that `rows` lack keep their
    value. A delete wins over a row of equal order; among other ties the row that sorts first. A batch is cut to one
    row and one delete a key before it is shuffled, so a key meets few candidates however hot it is.
    """
    order = list(newest)
    missing = [c for c in [*keys, *order] if c not in rows.columns]
    if missing:
        raise ValueError(f"rows of a newest-wins upsert need the columns {', '.join(missing)}")
    marks = [f"__o{i}" for i in range(len(order))]
    flag = delete_flag(rows, hard_delete) if hard_delete and hard_delete in rows.columns else F.lit(False)
    given = [c for c in rows.columns if c not in keys]
    columns = given if old is None else [*(c for c in old.columns if c not in keys), *(c for c in given if c not in old.columns)]

    def as_marks(value: str | None = None) -> dict:
        return {m: F.col(f"{value}.`{c}`" if value else f"`{c}`") for m, c in zip(marks, order, strict=True)}

    def has(names: Sequence[str]):
        return F.array(*[F.lit(n) for n in names]).cast("array<string>")

    live = dedup(rows.filter(~flag), keys, newest).withColumns({**as_marks(), "__dead": F.lit(False), "__has": has(given)})
    dead = dedup(rows.filter(flag).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *order])]), keys, newest).withColumns({**as_marks(), "__dead": F.lit(True), "__has": has([])})
    candidates = evolve_union(live, dead.select(*[F.col(f"`{c}`") for c in keys], *marks, "__dead", "__has"))
    if old is not None:
        stored = [c for c in old.columns if c not in keys]
        known = old
        if memory is not None:
            remembered = memory.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], SET)
            known = old.join(remembered, on_keys(keys), "left").drop(*[f"__k{i}" for i in range(len(keys))])
            apart = F.coalesce(F.map_keys(SET), has([]))
            own = known.withColumns({**as_marks(), "__dead": F.lit(False), "__has": F.array_except(has(stored), apart)}).drop(SET)
            other = known.select("*", F.explode(SET).alias("__c", "__at")).filter(F.col("__at").isNotNull())
            other = other.withColumns({**as_marks("__at"), "__dead": F.lit(False), "__has": F.array("__c")}).drop(SET, "__c", "__at")
            candidates = evolve_union(evolve_union(own, other), candidates)
        else:
            candidates = evolve_union(known.withColumns({**as_marks(), "__dead": F.lit(False), "__has": has(stored)}), candidates)
    if memory is not None:
        gone = memory.filter(F.col(DELETED).isNotNull()).withColumns({**as_marks(DELETED), "__dead": F.lit(True), "__has": has([])})
        candidates = evolve_union(candidates, gone.select(*[F.col(f"`{c}`") for c in keys], *marks, "__dead", "__has"))

    by_key = [F.col(f"`{k}`") for k in keys]
    ranks = [F.col(m).desc_nulls_last() if newest[c] == "desc" else F.col(m).asc_nulls_last() for m, c in zip(marks, order, strict=True)]
    ties = [sortable(candidates, c).asc_nulls_last() for c in columns]
    ranked = candidates.withColumn("__rn", F.row_number().over(Window.partitionBy(*by_key).orderBy(*ranks, F.col("__dead").desc(), *ties)))
    ranked = ranked.withColumn("__until", F.min(F.when(F.col("__dead"), F.col("__rn"))).over(Window.partitionBy(*by_key)))
    ranked = ranked.withColumn("__lives", ~F.col("__dead") & (F.col("__until").isNull() | (F.col("__rn") < F.col("__until"))))
    at = F.struct(*[F.col(m).alias(c) for m, c in zip(marks, order, strict=True)])
    value = [
        F.min_by(F.struct(F.col(f"`{c}`").alias("v"), at.alias("o")), F.when(F.col("__lives") & F.array_contains("__has", c), F.col("__rn"))).alias(f"__v{i}")
        for i, c in enumerate(columns)
    ]
    found = ranked.groupBy(*by_key).agg(
        *value, F.min_by(at, F.when(F.col("__lives"), F.col("__rn"))).alias("__at"), F.min_by(at, F.when(F.col("__dead"), F.col("__rn"))).alias(DELETED)
    )
    apart = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"__v{i}.o").alias("o")) for i, c in enumerate(columns)])
    apart = F.filter(apart, lambda e: F.col("__at").isNotNull() & (e["o"].isNull() | ~e["o"].eqNullSafe(F.col("__at"))))
    return found.select(
        *by_key, *[F.col(f"__v{i}.v").alias(c) for i, c in enumerate(columns)], F.col("__at").isNotNull().alias(ALIVE), DELETED, F.map_from_entries(apart).alias(SET)
    )


def remembered(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The memory's rows among the keys of `newest_wins`."""
    return found.filter(F.col(DELETED).isNotNull() | (F.size(SET) > 0)).select(*[F.col(f"`{k}`") for k in keys], DELETED, SET)
