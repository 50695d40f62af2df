"""Name -> (Spark query, equivalent DuckDB SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finance as fin
from ..session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}
MODULE_OF: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        MODULE_OF[name] = fn.__module__.rsplit(".", 1)[-1]
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that sums added in another order compare equal.

    The shift keeps exact half-way values (averages of few-digit numbers) off the tie.
    """
    shift = 10.0 ** -(digits + 3)
    return df.select(
        *[fin.rounded(F.col(f"`{f.name}`") + shift, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
          for f in df.schema]
    )
