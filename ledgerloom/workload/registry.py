"""Registered queries and the SQL that defines their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL it must agree with."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(function(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return function

    return register


def portable(df: DataFrame) -> DataFrame:
    """Columns in the types that compare alike across engines: bigint, double,
    boolean and text."""
    return df.selectExpr(*[f"{_portable(f)} as `{f.name}`" for f in df.schema.fields])


def _portable(field: T.StructField) -> str:
    column = f"`{field.name}`"
    if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
        return f"cast({column} as bigint)"
    if isinstance(field.dataType, T.DecimalType):
        return f"cast({column} as double)"
    if isinstance(field.dataType, T.DateType):
        return f"cast({column} as string)"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    return column
