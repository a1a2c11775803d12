"""Connection settings from environment variables, with defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession, types as T

from starmart.contracts import DIMENSION_KEYS, MARTS, STAR, TABLE_KEYS
from starmart.sources.tables import JdbcStore

# Variable names and connection defaults of the two databases.
STAR_DEFAULTS = {
    "POSTGRES_HOST": "postgres",
    "POSTGRES_PORT": "5432",
    "POSTGRES_DB": "sales",
    "POSTGRES_USER": "postgres",
    "POSTGRES_PASSWORD": "postgres",
}
MART_DEFAULTS = {
    "CLICKHOUSE_HOST": "clickhouse",
    "CLICKHOUSE_JDBC_PORT": "8123",
    "CLICKHOUSE_DB": "marts",
    "CLICKHOUSE_USER": "default",
    "CLICKHOUSE_PASSWORD": "clickhouse",
}
PROJECT_ROOT = "/opt/project"


# How the two databases spell the types of the contracts.
STAR_TYPES = {"bigint": "BIGINT", "int": "INT", "string": "TEXT", "date": "DATE"}
MART_TYPES = {"bigint": "Int64", "int": "Int32", "string": "String", "double": "Float64"}
COUNTED = "total_orders"  # never negative, like keys


def star_column(table: str, column: T.StructField) -> str:
    """Type and constraints of a column of the star: the first is the key, and keys of dimensions in the fact refer to them."""
    kind = column.dataType
    spelled = f"NUMERIC({kind.precision},{kind.scale})" if isinstance(kind, T.DecimalType) else STAR_TYPES[kind.simpleString()]
    if table in STAR and column.name == STAR[table].names[0]:
        return f"{spelled} PRIMARY KEY"
    referred = [name for name, key in DIMENSION_KEYS.items() if table == "fact_sales" and key == column.name]
    return f"{spelled} REFERENCES {referred[0]}({column.name})" if referred else spelled


def mart_column(table: str, column: T.StructField) -> str:
    """Type of a column of a mart; whether it may be NULL is part of it."""
    kind = MART_TYPES[column.dataType.simpleString()]
    if kind == "Int64" and (column.name in TABLE_KEYS[table] or column.name == COUNTED):
        kind = "UInt64"
    return f"Nullable({kind})" if column.nullable else kind


def _values(defaults: Mapping[str, str], env: Mapping[str, str]) -> dict[str, str]:
    return {name: env.get(name, default) for name, default in defaults.items()}


def source_root(env: Mapping[str, str] = os.environ) -> str:
    """Folder below which the sales files lie."""
    return env.get("PROJECT_ROOT", PROJECT_ROOT)


def driver_jars(env: Mapping[str, str] = os.environ) -> str:
    """JDBC driver files for ``spark.jars``, separated by commas."""
    return env.get("SPARK_JARS", "")


def star_database(spark: SparkSession, env: Mapping[str, str] = os.environ) -> JdbcStore:
    """The relational database of the star tables.

    Text is sent untyped, so the server converts it to the column's type. A
    refresh of a dimension also empties the fact that refers to it.
    """
    v = _values(STAR_DEFAULTS, env)
    return JdbcStore(
        spark,
        f"jdbc:postgresql://{v['POSTGRES_HOST']}:{v['POSTGRES_PORT']}/{v['POSTGRES_DB']}",
        {
            "user": v["POSTGRES_USER"],
            "password": v["POSTGRES_PASSWORD"],
            "driver": "org.postgresql.Driver",
            "stringtype": "unspecified",
        },
        schema_name="public",
        write_options={"cascadeTruncate": "true", "batchsize": "10000", "numPartitions": "64"},
        column_types=star_column,
    )


def mart_database(spark: SparkSession, env: Mapping[str, str] = os.environ) -> JdbcStore:
    """The column store of the marts."""
    v = _values(MART_DEFAULTS, env)
    return JdbcStore(
        spark,
        f"jdbc:clickhouse://{v['CLICKHOUSE_HOST']}:{v['CLICKHOUSE_JDBC_PORT']}/{v['CLICKHOUSE_DB']}",
        {
            "user": v["CLICKHOUSE_USER"],
            "password": v["CLICKHOUSE_PASSWORD"],
            "driver": "com.clickhouse.jdbc.ClickHouseDriver",
        },
        write_options={"batchsize": "100000", "numPartitions": "16"},
        create_options={
            mart: f"ENGINE = MergeTree() ORDER BY ({', '.join(TABLE_KEYS[mart])})" for mart in MARTS
        },
        column_types=mart_column,
    )
