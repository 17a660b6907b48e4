"""Parquet helpers and lake inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.folder import all_columns, list_files, parquet_footers

TARGET_FILE_BYTES = 128 * 1024 * 1024
LAYERS = ("raw", "staging", "consume")


def query_parquet(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Select, filter and limit; filter and columns reach the scan."""
    df = all_columns(spark).parquet(path)
    if where:
        df = df.where(F.expr(where))
    if columns:
        df = df.select(*[F.expr(c) for c in columns])
    return df.limit(limit) if limit is not None else df


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return all_columns(spark).parquet(path).select(*columns)


def parquet_schema(spark: SparkSession, path: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in all_columns(spark).parquet(path).schema}


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """One row; no column is read."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


def write_parquet(
    df: DataFrame, path: str, compression: str = "snappy", row_group_bytes: int | None = None
) -> str:
    writer = df.write.mode("overwrite").option("compression", compression)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def file_profile(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: rows, columns, row groups, bytes, codec, schema."""
    return parquet_footers(list_files(spark, path)).withColumnRenamed("fingerprint", "schema")


def compact_files(
    spark: SparkSession,
    paths: list[str],
    output: str,
    compression: str = "snappy",
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite many files as few of about the target size; returns how many.

    Whole files are packed into reads of the target size, and each read is written as one file: nothing is shuffled, and
    the rows of a file keep their order. A file beyond the target is cut at its row groups. Columns are matched by
    name, those that only some files have are kept; a column with several types is an error.
    """
    write_parquet(packed_reads(spark, paths, target_bytes), output, compression)
    return list_files(spark, output).count()


def packed_reads(spark: SparkSession, paths: list[str], target_bytes: int) -> DataFrame:
    """The files in partitions of about the target size, with settings that hold for this read alone."""
    session = spark.newSession()
    for key, value in {"maxPartitionBytes": target_bytes, "openCostInBytes": 0, "minPartitionNum": 1}.items():
        session.conf.set(f"spark.sql.files.{key}", str(value))
    return all_columns(session).parquet(*paths)


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file with its layer, group (source, domain or use case) and table."""
    tail = F.regexp_extract("path", rf"/({'|'.join(LAYERS)})/([^/]+)/([^/]+)/[^/].*$", 0)
    parts = F.split(tail, "/")
    return list_files(spark, root).select(
        parts[1].alias("layer"), parts[2].alias("owner"), parts[3].alias("table_name"), "path", "length"
    )


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and size per layer."""
    return (
        lake_files(spark, root)
        .groupBy("layer")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.round(F.sum("length") / F.lit(1024.0 * 1024.0), 2).alias("megabytes"),
        )
    )


def lake_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables per layer and owner."""
    return lake_files(spark, root).select("layer", "owner", "table_name").distinct()
