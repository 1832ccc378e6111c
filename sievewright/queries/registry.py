"""Registry of the queries on the driver tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is compared by brute force in tests."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without_keys(df: DataFrame, key: str, gone: str) -> DataFrame:
    """Every row of ``df``, but the keys under ``gone`` negated, so that references to them are broken."""
    return df.withColumn(key, F.when(F.expr(gone), -F.col(key)).otherwise(F.col(key)))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the doubles, as the SQL does: sums differ in their last bits."""
    return df.withColumns({c: F.round(F.col(c), digits) for c, t in df.dtypes if t == "double"})
