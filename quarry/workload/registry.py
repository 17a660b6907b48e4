"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


_schemas: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the file once."""
    path = f"{sf}/{name}.parquet"
    if (sf, name) not in _schemas:
        _schemas[sf, name] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[sf, name]).parquet(path)
