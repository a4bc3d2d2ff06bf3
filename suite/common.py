"""Registry and small helpers of the query suite."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.session import scratch_dir
from sluiceway.sinks.dataset import Dataset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SALT = "harbour-salt"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its oracle. Results are stated in UTC."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_dataset(spark: SparkSession, label: str) -> Dataset:
    return Dataset(spark, scratch_dir(spark, label))


def stamp(name: str):
    """A timestamp as text with microseconds, the form the oracles use too."""
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text; everything else as it is."""
    stamps = {f.name: stamp(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    return df.withColumns(stamps) if stamps else df


def sql_ts(expr: str) -> str:
    """The oracle's side of `stamp`."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


ORDERS_COLUMNS = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                  + sql_ts("o_orderdate") + " AS o_orderdate, o_orderpriority")
EVENT_COLUMNS = "event_id, " + sql_ts("ts") + " AS ts, user_id, event_type, value, props"
