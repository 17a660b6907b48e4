"""Mirrors that rewrite only the key ranges that changed, known from digests stored with the target.

A table is cut into ranges of its key. Each range has a digest (rows, and a checksum that does not depend on their
order); digests of 64 neighbouring ranges add up to one of the level above, and all of them to the root. The digests of
what was written are kept beside the target, so a later run reads the source once and of the target nothing but
digests: the root, then the nodes below those that differ.

Digests of ranges are taken back before these are written, and stored after it: a run that was lost in between is
seen by the next one, which writes the same ranges again.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialise
from quarry.sources.folder import nested_to_json

RANGE = "_range"
FAN = 6  # bits: 64 children of a node
LEVELS = 2  # above the ranges: nodes of 64 of them, and the root
NO_KEY = -(1 << 62)  # the range of rows without a key


@dataclass(frozen=True)
class KeyRanges:
    """Ranges of ``width`` from ``base`` for keys that count (numbers, days, seconds), else classes of the key's hash."""

    key: str
    base: int
    width: int
    classes: int = 0

    def number(self, kind: T.DataType) -> Column:
        """The range of a row; keys beyond those known at first make new ranges of the same width."""
        place = _counted(self.key, kind)
        if self.classes or place is None:
            place = F.pmod(F.xxhash64(F.col(f"`{self.key}`").cast("string")), F.lit(max(1, self.classes)))
            place = F.when(F.col(f"`{self.key}`").isNotNull(), place)
        else:
            place = F.floor((place - F.lit(self.base)) / F.lit(self.width))
        return F.coalesce(place.cast("long"), F.lit(NO_KEY))


def _counted(key: str, kind: T.DataType) -> Column | None:
    column = F.col(f"`{key}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(column.cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.floor(column).try_cast("long")
    return None


def ranges_of(df: DataFrame, key: str, rows_per_range: int = 1_000_000, most: int = 4096) -> KeyRanges:
    """Ranges of about this many rows if keys are spread evenly; not more than ``most`` of them at first."""
    place = _counted(key, df.schema[key].dataType)
    found = df.agg(F.count(F.lit(1)).alias("rows"), *([F.min(place).alias("lo"), F.max(place).alias("hi")] if place is not None else []))
    row = found.first()
    wanted = max(1, min(most, -(-row["rows"] // rows_per_range)))
    if place is None:
        return KeyRanges(key, 0, 1, wanted)
    lo, hi = row["lo"] or 0, row["hi"] or 0
    return KeyRanges(key, lo, -(-(hi - lo + 1) // wanted))


def leaf_digests(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """``node, rows, checksum`` of each range."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in sorted(df.columns)]
    hashed = df.select(ranges.number(df.schema[ranges.key].dataType).alias("node"), F.xxhash64(*texts).alias("h"))
    return hashed.groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("checksum")
    )


def tree(leaves: DataFrame) -> DataFrame:
    """The digests of all levels: ``level`` 0 is the root, ``LEVELS`` the ranges. ``done`` is false below a lost write."""
    sums = [F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"), F.min("done").alias("done")]
    inner = leaves.groupBy(F.shiftright("node", FAN).alias("node")).agg(*sums)
    root = leaves.groupBy(F.lit(0).cast("long").alias("node")).agg(*sums)
    columns = ["level", "node", "rows", "checksum", "done"]
    levels = [(0, root), (1, inner), (LEVELS, leaves)]
    parts = [part.withColumn("level", F.lit(level)).select(*columns) for level, part in levels]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def differing(ours: DataFrame, theirs: DataFrame) -> DataFrame | None:
    """``node`` of the ranges whose digests differ or exist on one side only, level by level; None if none does."""

    def level(number: int) -> DataFrame:
        key = ["node"]
        mine, other = (t.where(F.col("level") == number).select(*key, F.struct("rows", "checksum", "done").alias(n)) for t, n in ((ours, "a"), (theirs, "b")))
        return mine.join(other, key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(*key)

    if level(0).isEmpty():
        return None
    nodes = level(1).withColumnRenamed("node", "above")
    leaves = level(LEVELS).withColumn("above", F.shiftright("node", FAN))
    return leaves.join(nodes, "above", "left_semi").select("node")


@dataclass(frozen=True)
class RangedFolder:
    """Tables as Parquet folders with one partition for each key range, and their digests beside them."""

    spark: SparkSession
    root: str
    rows_per_range: int = 1_000_000

    def _stored(self, table: str, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{table}/{part}")
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self, table: str) -> DataFrame | None:
        """The mirrored rows; ranges that the source no longer has are left out, whether or not their files remain."""
        data, digests = self._stored(table, "data"), self._stored(table, "digests")
        if data is None or digests is None:
            return None
        live = digests.where((F.col("level") == LEVELS) & (F.col("rows") > 0)).select(F.col("node").alias(RANGE))
        return data.withColumn(RANGE, F.col(RANGE).cast("long")).join(live, RANGE, "left_semi").drop(RANGE)

    def _plan(self, table: str) -> tuple[KeyRanges, list] | None:
        stored = self._stored(table, "plan")
        if stored is None or (row := stored.first()) is None:
            return None
        return KeyRanges(**json.loads(row["ranges"])), json.loads(row["columns"])

    def mirror(self, df: DataFrame, table: str, key: str) -> tuple[str, int]:
        """What was done (create, recreate, update or skip) and how many ranges were written."""
        df = nested_to_json(df)
        columns = [[f.name, f.dataType.simpleString()] for f in df.schema]
        plan, theirs = self._plan(table), self._stored(table, "digests")
        fits = plan is not None and theirs is not None and plan[0].key == key and plan[1] == columns
        ranges = plan[0] if fits else ranges_of(df, key, self.rows_per_range)
        leaves = materialise(leaf_digests(df, ranges).withColumn("done", F.lit(True)), "digests")
        ours, path = tree(leaves), f"{self.root}/{table}"
        numbered = df.withColumn(RANGE, ranges.number(df.schema[key].dataType))
        if not fits:
            # all that is known of the old table goes first, so that a lost run begins anew
            record = [(json.dumps(asdict(ranges)), json.dumps(columns))]
            self.spark.createDataFrame([], "level int, node long, rows long, checksum decimal(38,0), done boolean").write.mode(
                "overwrite"
            ).parquet(f"{path}/digests")
            _dealt(numbered, key).write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/data")
            self.spark.createDataFrame(record, "ranges string, columns string").write.mode("overwrite").parquet(f"{path}/plan")
            ours.write.mode("overwrite").parquet(f"{path}/digests")
            return ("create" if plan is None else "recreate"), leaves.count()
        changed = differing(ours, theirs)
        if changed is None:
            return "skip", 0
        changed = materialise(changed, "ranges")
        pending = theirs.where(F.col("level") == LEVELS).join(changed, "node", "left_anti").select("node", "rows", "checksum", "done")
        held = changed.select("node", F.lit(1).cast("long").alias("rows"), F.lit(0).cast("decimal(38,0)").alias("checksum"), F.lit(False).alias("done"))
        pending = materialise(tree(pending.unionAll(held)), "digests")
        pending.write.mode("overwrite").parquet(f"{path}/digests")
        rewritten = numbered.join(changed.withColumnRenamed("node", RANGE), RANGE, "left_semi")
        (
            _dealt(rewritten.select(*df.columns, RANGE), key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(RANGE)
            .parquet(f"{path}/data")
        )
        ours.write.mode("overwrite").parquet(f"{path}/digests")
        return "update", changed.count()


def _dealt(numbered: DataFrame, key: str) -> DataFrame:
    """By ranges of the key: a large range is written by several tasks, a small one by one."""
    return numbered.repartitionByRange(RANGE, f"`{key}`")
