"""Join shapes used by the models.

No join carries a broadcast hint: Spark broadcasts a side when its file size, or its size
measured at run time, is under the configured threshold, and shuffles (splitting skewed
partitions) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_matching(
    df: DataFrame, other: DataFrame, on: str, other_on: str | None = None, unique: bool = False
) -> DataFrame:
    """Semi join against the distinct keys of ``other``; copies collapse before the shuffle.

    Say ``unique`` when ``on`` has no repeated values in ``df``: the shuffle of the distinct
    keys then serves the join as well. Otherwise the keys are shuffled once more, which lets
    Spark split a hot key of ``df`` over several tasks.
    """
    keys = _distinct_keys(other, other_on or on)
    return df.join(keys, _same(on, "__match", unique), "left_semi")


def keep_unmatched(
    df: DataFrame, other: DataFrame, on: str, other_on: str | None = None, unique: bool = False
) -> DataFrame:
    """Anti join, with the same treatment of copies and hot keys; a NULL key has no match."""
    keys = _distinct_keys(other, other_on or on)
    return df.join(keys, _same(on, "__match", unique), "left_anti")


def left_join_many(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    left_keys: DataFrame | None = None, right_keys: DataFrame | None = None,
) -> DataFrame:
    """Left join of a table with unique keys to a table that may hold very many rows of one key.

    Spark can split a hot key on either side of an inner join, but not on the right side of a
    left join; so the keys that have no row on the right get one, and one inner join takes both sides.
    ``left_keys`` (these keys or more) and ``right_keys`` are tables with the key columns that are cheaper to compute.
    """
    present = right.where(F.col(right_key).isNotNull()).withColumn("__present", F.lit(True))
    keys = (left if left_keys is None else left_keys).select(left_key)
    unmatched = keep_unmatched(keys, right if right_keys is None else right_keys, left_key, right_key)
    missing = unmatched.distinct().select(F.col(left_key).alias(right_key), F.lit(False).alias("__present"))
    joined = left.join(present.unionByName(missing, allowMissingColumns=True), _same(left_key, right_key, unique=False))
    key = F.when(F.col("__present"), F.col(right_key)).alias(right_key)
    return joined.select(*left.columns, *[key if c == right_key else c for c in right.columns])


def _same(left: str, right: str, unique: bool) -> Column:
    """Equality of keys whose right side has no NULL.

    Spark splits skewed partitions only when both sides of a sort-merge join come straight from
    a shuffle. The null-safe form is hashed differently from the plain key, so an aggregate on
    the key below the join is followed by a shuffle of its own.
    """
    return F.col(left) == F.col(right) if unique else F.col(left).eqNullSafe(F.col(right))


def _distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("__match")).where("__match is not null").distinct()


def with_group_totals(df: DataFrame, groups: list[str], totals: list[Column]) -> DataFrame:
    """Aggregates OVER (PARTITION BY groups) without gathering a group in one task."""
    summary = df.groupBy(*[F.col(g).alias(f"__t_{g}") for g in groups]).agg(*totals)
    condition = F.lit(True)
    for g in groups:
        condition = condition & F.col(g).eqNullSafe(F.col(f"__t_{g}"))
    return df.join(summary, condition, "left").drop(*[f"__t_{g}" for g in groups])


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as constants (scalar subquery, no join)."""
    holder = one_row.select(F.struct(*one_row.columns)).scalar()
    names = one_row.columns
    staged = df.withColumn("__scalars", holder)
    return staged.select(*df.columns, *[F.col(f"__scalars.{n}").alias(n) for n in names])
