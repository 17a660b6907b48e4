"""Numbers in an order, over any number of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialise

BROADCAST_ROWS = 1_000_000  # offsets of tasks; about 40 bytes each


def ranked(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The input with ``rank``, the number of each row in its group from 0, by the order.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over many tasks; each task counts
    its own rows, and the counts of the tasks (one row for each task and group that it has) give the offsets.
    ``group`` must not be null; the order should leave no ties (tied rows get numbers in no certain order).
    """
    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialise(placed.withColumn("__place", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("__task", F.shiftright("__place", 33))
    tasks = placed.groupBy("__task", group).agg(F.count("*").alias("__rows"), F.min("__place").alias("__first"))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("__task", group, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    tasks = materialise(tasks, "ranks")
    # one row for each task, and one for each border between groups: counted before it is broadcast
    if tasks.count() <= BROADCAST_ROWS:
        tasks = F.broadcast(tasks)
    return placed.join(tasks, ["__task", group]).withColumn(
        "rank", F.col("__place") - F.col("__first") + F.col("__before")
    ).drop("__task", "__place", "__first", "__before")
