"""SQL databases through Spark's JDBC source. Driver jars are the user's."""

from __future__ import annotations

import re
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

# Scheme -> (JDBC prefix, driver class).
DRIVERS = {
    "postgresql": ("jdbc:postgresql:", "org.postgresql.Driver"),
    "postgres": ("jdbc:postgresql:", "org.postgresql.Driver"),
    "redshift": ("jdbc:redshift:", "com.amazon.redshift.Driver"),
    "clickhouse": ("jdbc:clickhouse:", "com.clickhouse.jdbc.ClickHouseDriver"),
    "mysql": ("jdbc:mysql:", "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("jdbc:mariadb:", "org.mariadb.jdbc.Driver"),
    "mariadb+pymysql": ("jdbc:mariadb:", "org.mariadb.jdbc.Driver"),
    "mssql": ("jdbc:sqlserver:", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "synapse": ("jdbc:sqlserver:", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "snowflake": ("jdbc:snowflake:", "net.snowflake.client.jdbc.SnowflakeDriver"),
    "sqlite": ("jdbc:sqlite:", "org.sqlite.JDBC"),
    "duckdb": ("jdbc:duckdb:", "org.duckdb.DuckDBDriver"),
    "md": ("jdbc:duckdb:", "org.duckdb.DuckDBDriver"),
}


def jdbc_options(uri: str) -> dict[str, str]:
    """Reader and writer options for a connection URI. Its query parameters, such as sslmode, stay in the URL."""
    parts = urlsplit(uri)
    scheme = parts.scheme.lower()
    if scheme not in DRIVERS:
        raise ValueError(f"no JDBC route for scheme: {scheme}")
    prefix, driver = DRIVERS[scheme]
    options = {"driver": driver}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    params = {k: v[0] for k, v in parse_qs(parts.query).items()}
    host = parts.hostname or ""
    port = f":{parts.port}" if parts.port else ""
    database = parts.path.lstrip("/")
    if scheme in ("sqlite", "duckdb"):
        options["url"] = prefix + re.sub(r"^\w+:/{2,3}(?=[/A-Za-z])", "", uri)
    elif scheme == "md":
        options["url"] = f"{prefix}md:{host}"
        options["motherduck_token"] = params.get("token", "")
    elif scheme in ("mssql", "synapse"):
        options["url"] = f"{prefix}//{host}{port};databaseName={database}" + "".join(f";{k}={v}" for k, v in params.items())
    elif scheme == "snowflake":
        names = database.split("/")
        options["url"] = f"{prefix}//{host}.snowflakecomputing.com/?db={names[0]}" + (
            f"&schema={names[1]}" if len(names) > 1 else ""
        ) + (f"&{parts.query}" if parts.query else "")
    elif scheme == "clickhouse":
        secure = params.get("secure", "0") == "1"
        options["url"] = f"{prefix}//{host}:{params.get('http_port', '8123')}/{database}" + ("?ssl=true" if secure else "")
    else:
        options["url"] = f"{prefix}//{host}{port}/{database}" + (f"?{parts.query}" if parts.query else "")
    return options


def read_table(
    spark: SparkSession,
    uri: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table scan. Filters and columns are pushed to the database by the planner.

    A large table needs `split_column` and its bounds, so that many tasks each read
    one key range; without them JDBC reads through a single connection.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(uri), dbtable=table, fetchsize=str(fetch_size))
    if split_column:
        if bounds is None:
            raise ValueError("a split scan needs the lower and upper bound of its column")
        reader = reader.options(
            partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(splits)
        )
    return reader.load()


def write_table(df: DataFrame, uri: str, table: str, mode: str, batch_size: int = 10_000) -> None:
    """Append, create, or replace by truncating (which keeps the table's definition, grants and views)."""
    if mode not in ("append", "overwrite", "errorifexists"):
        raise ValueError(f"mode must be 'append', 'overwrite' or 'errorifexists', got {mode!r}")
    writer = df.write.format("jdbc").options(**jdbc_options(uri), dbtable=table, batchsize=str(batch_size))
    writer.option("truncate", str(mode == "overwrite").lower()).mode(mode).save()
