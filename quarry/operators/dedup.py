"""One row per key, and duplicate marking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """Keep the first row of each key.

    The order is made total with a hash of the row, so reruns agree. Spark limits each
    task's output to one row per key before the shuffle (WindowGroupLimit), which keeps a
    key with very many copies harmless.
    """
    total = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()]
    window = Window.partitionBy(*keys).orderBy(*total)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def latest_version(df: DataFrame, keys: list[str | Column], version: str | Column) -> DataFrame:
    version = F.col(version) if isinstance(version, str) else version
    return best_row(df, keys, [version.desc_nulls_last()])


def mark_duplicates(
    df: DataFrame, keys: list[str], row_id: str, flag: str = "is_duplicate"
) -> DataFrame:
    """True on every row of a key but the one with the smallest row id (ids are unique).

    The first rows are found with a mergeable aggregate and matched back on the row id, so
    a key shared by a large part of the table is never gathered in one place.
    """
    firsts = df.groupBy(*keys).agg(F.min(row_id).alias("__first")).select("__first")
    matched = df.join(firsts, F.col(row_id) == F.col("__first"), "left")
    return matched.withColumn(flag, F.col("__first").isNull()).drop("__first")
