"""The three layers of a lake as Parquet folders."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.sources.folder import has_files, read_folder
from quarry.sources.footers import read_recorded, record
from quarry.sources.generations import BATCH, GENERATION, read_generations, schemas
from quarry.sources.registry import with_lineage

PARTITIONS = ["year", "month", "day"]
# Raw batches are mostly read once; staging and consume tables are full of digests in hexadecimal, which take
# half with zstd and are not shortened by snappy.
RAW_CODEC, MODEL_CODEC = "snappy", "zstd"


@dataclass(frozen=True)
class Written:
    path: str
    rows: int
    measures: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Lake:
    """Paths below one root: raw/{source}/{table}, staging/{domain}/{table}, consume/{use}/{table}."""

    root: str

    def raw_path(self, source: str, table: str) -> str:
        return f"{self.root}/raw/{source}/{table}"

    def staging_path(self, table: str, domain: str = "default") -> str:
        return f"{self.root}/staging/{domain}/{table}"

    def consume_path(self, table: str, use_case: str = "bi") -> str:
        return f"{self.root}/consume/{use_case}/{table}"

    # --- raw ---------------------------------------------------------------------------

    def write_raw(
        self,
        df: DataFrame,
        source: str,
        table: str,
        mode: str = "append",
        measures: dict[str, Column] | None = None,
    ) -> Written:
        """Write a batch below its ingestion date.

        ``append`` keeps earlier batches of the same day; ``replace_day`` replaces that day only.
        ``measures`` are aggregates taken while writing.
        """
        if "_ingestion_timestamp" not in df.columns:
            df = with_lineage(df, source)
        stamp = F.col("_ingestion_timestamp")
        dated = df.withColumns(
            {
                "year": F.date_format(stamp, "yyyy"),
                "month": F.date_format(stamp, "MM"),
                "day": F.date_format(stamp, "dd"),
            }
        )
        path = self.raw_path(source, table)
        if schemas(df.sparkSession, path):
            raise ValueError(f"{source}.{table} is fed by a stream; its batches are written by ingest_new_files")
        if mode == "append":
            written = _write(dated, path, "append", PARTITIONS, measures)
        elif mode == "replace_day":
            written = _write(
                dated, path, "overwrite", PARTITIONS, measures, partitionOverwriteMode="dynamic"
            )
        else:
            raise ValueError(f"raw write mode {mode!r}; use 'append' or 'replace_day'")
        record(df.sparkSession, path)
        return written

    def record_raw(self, spark: SparkSession, source: str, table: str) -> None:
        """Record the schemas of files that others wrote, so that reads need not open their footers."""
        record(spark, self.raw_path(source, table))

    def read_raw(
        self,
        spark: SparkSession,
        source: str,
        table: str,
        date_from: str | None = None,
        date_to: str | None = None,
        lenient: bool = False,
    ) -> DataFrame:
        """A raw table, optionally between two ingestion times (both inclusive).

        The bounds are also put on the partition columns, so other days are not listed for
        reading. Columns of all batches are read; ``lenient`` also takes columns whose types
        differ between batches, which are an error otherwise. The schemas of batches are recorded
        when they are written, by streams too, so their footers are not opened again.
        """
        path = self.raw_path(source, table)
        day, stamp = F.make_date(*[F.col(p).cast("int") for p in PARTITIONS]), F.col("_ingestion_timestamp")
        days, times = F.lit(True), F.lit(True)
        if date_from:
            bound = F.lit(date_from).cast("timestamp")
            days, times = days & (day >= bound.cast("date")), times & (stamp >= bound)
        if date_to:
            bound = F.lit(date_to).cast("timestamp")
            days, times = days & (day <= bound.cast("date")), times & (stamp <= bound)
        bounded = bool(date_from or date_to)
        df = read_generations(spark, path, PARTITIONS)
        if df is not None:
            df = df.drop(GENERATION, BATCH)
        else:
            df = read_recorded(spark, path, lenient, days if bounded else None)
        if df is None:
            raise FileNotFoundError(f"no raw files for {source}.{table}")
        return df.where(days & times) if bounded else df

    def register_raw_views(
        self, spark: SparkSession, tables: dict[str, tuple[str, str]], lenient: bool = True
    ) -> int:
        """Register {view: (source, table)} for the tables that have files; none is an error."""
        registered = 0
        for view, (source, table) in tables.items():
            if has_files(spark, self.raw_path(source, table)):
                self.read_raw(spark, source, table, lenient=lenient).createOrReplaceTempView(view)
                registered += 1
        if not registered:
            raise FileNotFoundError(f"no raw tables below {self.root}/raw")
        return registered

    # --- staging and consume -------------------------------------------------------------

    def write_staging(self, df: DataFrame, table: str, domain: str = "default") -> Written:
        return _replace(df, self.staging_path(table, domain))

    def pend_staging(self, df: DataFrame, table: str, domain: str = "default") -> Pending:
        """Write a staging table that is published, or discarded, after its checks."""
        fresh = f"{self.root}/_pending/{table}-{uuid.uuid4().hex}"
        return _pend(df, fresh, self.staging_path(table, domain))

    def read_staging(self, spark: SparkSession, table: str, domain: str = "default") -> DataFrame:
        return spark.read.parquet(self.staging_path(table, domain))

    def write_consume(self, df: DataFrame, table: str, use_case: str = "bi") -> Written:
        """Technical columns (leading underscore) do not reach this layer."""
        business = df.drop(*[c for c in df.columns if c.startswith("_")])
        return _replace(business, self.consume_path(table, use_case))

    def read_consume(self, spark: SparkSession, table: str, use_case: str = "bi") -> DataFrame:
        return spark.read.parquet(self.consume_path(table, use_case))


def _write(
    df: DataFrame,
    path: str,
    mode: str,
    partitions: list[str] | None = None,
    measures: dict[str, Column] | None = None,
    codec: str = RAW_CODEC,
    **options: str,
) -> Written:
    """Write and count in the same pass."""
    counted = Observation()
    wanted = [c.alias(name) for name, c in (measures or {}).items()]
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *wanted)
    writer = observed.write.mode(mode).options(**options).option("compression", codec)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    found = dict(counted.get)
    return Written(path, found.pop("rows"), found)


def _replace(df: DataFrame, path: str) -> Written:
    """Put a table in the place of an earlier one once it is complete; a job that fails leaves the earlier one.

    It is written to a hidden folder beside the table, and both change places by renames. ``df`` may read the table.
    """
    above, _, name = path.rstrip("/").rpartition("/")
    return _pend(df, f"{above}/_new-{name}-{uuid.uuid4().hex}", path).publish()


@dataclass(frozen=True)
class Pending:
    """A complete table in a hidden folder of the lake; published by a rename, or discarded."""

    spark: SparkSession
    written: Written
    target: str

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.written.path)

    def publish(self) -> Written:
        above, _, name = self.target.rstrip("/").rpartition("/")
        earlier = f"{above}/_old-{name}-{uuid.uuid4().hex}"
        location, files = _files_of(self.spark, self.target)

        def move(source: str, target: str) -> None:
            if not files.rename(location(source), location(target)):
                raise OSError(f"{source} could not be renamed to {target}")

        files.mkdirs(location(above))
        replaced = files.exists(location(self.target))
        if replaced:
            move(self.target, earlier)
        move(self.written.path, self.target)
        if replaced:
            files.delete(location(earlier), True)
        self.spark.catalog.refreshByPath(self.target)
        return Written(self.target, self.written.rows, self.written.measures)

    def discard(self) -> None:
        location, files = _files_of(self.spark, self.target)
        files.delete(location(self.written.path), True)


def _files_of(spark: SparkSession, path: str) -> tuple:
    location = spark._jvm.org.apache.hadoop.fs.Path
    return location, location(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _pend(df: DataFrame, fresh: str, path: str) -> Pending:
    """Write a table to a hidden folder; a job that fails leaves nothing there."""
    spark = df.sparkSession
    try:
        return Pending(spark, _write(df, fresh, "errorifexists", codec=MODEL_CODEC), path)
    except BaseException:
        location, files = _files_of(spark, path)
        files.delete(location(fresh), True)
        raise


def ingest_folders(
    spark: SparkSession, lake: Lake, source: str, folders: dict[str, dict], mode: str = "append"
) -> dict[str, int]:
    """Read {table: {path, format}} one table after the other into raw; empty folders are skipped."""
    totals = {}
    for table, folder in folders.items():
        df = read_folder(spark, folder["path"], folder.get("format", "parquet"))
        if df is not None:
            totals[table] = lake.write_raw(df, source, table, mode).rows
    return totals
