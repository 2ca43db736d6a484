"""Registering a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..oracle import compose
from ..plans.warehouse import Warehouse, warehouse
from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types other engines have under the same name: decimals as doubles, zoneless times."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.ShortType):
            return F.col(f.name).cast("int").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema])


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Warehouse], DataFrame]], Callable]:
    """Register ``fn(warehouse)`` under a name, with its check query if SQL can express one."""

    def register(fn: Callable[[Warehouse], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(warehouse(prepare(spark), sf_dir.rstrip("/"))))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = compose(sql)
        return fn

    return register
