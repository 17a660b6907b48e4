"""Literal reference data as a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inline_relation(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Rows given in the code. Spark knows how small they are, so joins are planned well."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
