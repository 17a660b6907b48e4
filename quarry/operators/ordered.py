"""Exact ranks and percentiles that never put a whole group into one task.

Rows (or distinct values with counts) are dealt by ranges of (group, value) in one exchange and written in that
order. A row then has a place: its task and its number in it. Tasks hold consecutive ranges, so the rows of the
tasks before - one number for each task - turn places into positions in the whole order.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialise


def _task() -> Column:
    return F.shiftright("__place", 33).alias("__task")


def _placed(df: DataFrame, order: list[str | Column], ranges: int | None) -> DataFrame:
    """The rows written in this order, with ``__place``: the task's number in the high bits, the row's in the low ones."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())


def with_ranks(
    df: DataFrame, groups: list[str], ranks: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """Add RANK() OVER (PARTITION BY groups ORDER BY value DESC NULLS LAST) per {value: name}.

    Each rank deals the rows once by ranges of (groups, value, hash of the row), so neither a large group nor a
    value that many rows share is one task's; only rows that are equal in all columns stay together. The rank is the
    position of the first row of a value, less that of the first row of its group.
    """
    for value, rank in ranks.items():
        df = _ranked(df, groups, value, rank, ranges)
    return df


def _ranked(df: DataFrame, groups: list[str], value: str, rank: str, ranges: int | None) -> DataFrame:
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*[F.col(g) for g in groups], F.col(value).desc_nulls_last(), F.xxhash64(*hashed)]
    placed = materialise(_placed(df, order, ranges), "ranks")
    # a row for each task
    tasks = placed.groupBy(_task()).agg(F.count(F.lit(1)).alias("rows")).orderBy("__task").collect()
    before = dict(zip([t["__task"] for t in tasks], accumulate([0, *[t["rows"] for t in tasks]]), strict=False))
    # a local relation, whose size the planner knows
    offsets = df.sparkSession.createDataFrame(
        pa.table({"__task": pa.array(before.keys(), pa.int64()), "__before": pa.array(before.values(), pa.int64())})
    )
    firsts = placed.groupBy(*groups, value).agg(F.min("__place").alias("__place")).withColumn("__task", _task())
    firsts = firsts.join(offsets, "__task").select(
        *[F.col(c).alias(f"__k_{c}") for c in (*groups, value)],
        (F.col("__before") + F.col("__place").bitwiseAND((1 << 33) - 1)).alias("__position"),
    )
    starts = firsts.groupBy(*[F.col(f"__k_{g}").alias(f"__g_{g}") for g in groups]).agg(F.min("__position").alias("__start"))
    known = firsts.join(starts, _same({f"__k_{g}": f"__g_{g}" for g in groups}))
    joined = placed.join(known, _same({c: f"__k_{c}" for c in (*groups, value)}))
    return joined.select(*df.columns, (F.col("__position") - F.col("__start") + 1).alias(rank))


def exact_percentiles(
    df: DataFrame, value: str, points: dict[str, float], ranges: int | None = None
) -> DataFrame:
    """One row with the linearly interpolated percentile of every named point."""
    return percentiles_of(df, {value: points}, ranges)


def percentiles_of(
    df: DataFrame, points: dict[str, dict[str, float]], ranges: int | None = None
) -> DataFrame:
    """One row with the percentiles {column: {name: point}} of several columns, from one pass over them.

    (column, value, count) is dealt by ranges once. The sum of counts of each task says which tasks hold the wanted
    positions; only these are read again.
    """
    columns = list(points)
    pairs = F.array(
        *[F.struct(F.lit(i).alias("c"), F.col(column).cast("double").alias("v")) for i, column in enumerate(columns)]
    )
    counts = (
        df.select(F.inline(pairs)).where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    placed = materialise(_placed(counts, ["c", "v"], ranges), "percentiles")
    # a row for each task and column
    totals = placed.groupBy(_task(), "c").agg(F.sum("n").alias("rows")).orderBy("c", "__task").collect()
    wanted, picks = [], []
    for i, column in enumerate(columns):
        sizes = [(t["__task"], t["rows"]) for t in totals if t["c"] == i]
        ends = list(accumulate(n for _, n in sizes))
        rows = ends[-1] if ends else 0
        edges = set()
        for name, point in points[column].items():
            position = point * (rows - 1)
            low, high = int(position // 1), int(-(-position // 1))
            edges |= {low, high}
            # the value at position k is the smallest one with more than k rows up to it
            at = lambda k: F.min(F.when((F.col("c") == i) & (F.col("reach") > k), F.col("v")))  # noqa: B023, E731
            picks.append((at(low) + (at(high) - at(low)) * F.lit(position - low)).alias(name))
        for (task, n), end in zip(sizes, ends, strict=True):
            if any(end - n <= k < end for k in edges):
                wanted.append((i, task, end - n))
    if not wanted:
        wanted = [(-1, -1, 0)]
    held = reduce(
        lambda a, b: a | b,
        [(F.col("c") == c) & F.col("__place").between(task << 33, ((task + 1) << 33) - 1) for c, task, _ in wanted],
    )
    start = reduce(
        lambda rest, w: F.when((F.col("c") == w[0]) & (F.col("__task") == w[1]), F.lit(w[2])).otherwise(rest),
        wanted,
        F.lit(0),
    )
    inside = Window.partitionBy("c", "__task").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cumulated = placed.where(held).withColumn("__task", _task()).withColumn("reach", start + F.sum("n").over(inside))
    return cumulated.agg(*picks)


def _same(pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs.items()])
