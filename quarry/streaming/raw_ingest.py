"""Incremental folder ingestion: each file is read once, however often the job runs and whatever its columns are."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.folder import aligned, nested_to_json, parquet_footers, union_promoted
from quarry.sources.generations import write_generation
from quarry.sources.layers import PARTITIONS, Lake
from quarry.sources.registry import with_lineage

#: Files of a micro-batch; their names pass through the driver, as in any file stream.
MAX_FILES = 10_000


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    source: str,
    table: str,
    checkpoint: str,
    pattern: str = "*.parquet",
    schema: str | None = None,
    max_files: int = MAX_FILES,
) -> str:
    """Append the files that arrived since the last run to raw, then stop; ``Lake.read_raw`` reads the table.

    The stream carries file names; each micro-batch reads its files by their own schemas and aligns them to a
    target that grows: a new column is added, a changed type promoted (numbers to doubles, else text), nested
    values become JSON text. With ``schema`` only its columns are taken, in its types (NULL where a value has
    none). A batch has a name and a time that stay the same when it is run again after a loss, and replaces what an
    earlier attempt left, so no row is lost or repeated. A new checkpoint takes all files of the folder again.
    """
    path = lake.raw_path(source, table)
    arrived = (
        spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
        .format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        # the batch's own time, kept in the checkpoint
        .select("path", "length", F.unix_micros(F.current_timestamp()).alias("arrived"))
    )

    def take(files: DataFrame, number: int) -> None:
        batch = read_batch(spark, files, schema)
        if batch is None:
            return
        stamp = F.timestamp_micros(F.lit(files.agg(F.max("arrived")).first()[0]))
        dated = with_lineage(batch, source).withColumns(
            {
                "_ingestion_timestamp": stamp,
                "year": F.date_format(stamp, "yyyy"),
                "month": F.date_format(stamp, "MM"),
                "day": F.date_format(stamp, "dd"),
            }
        )
        write_generation(dated, path, PARTITIONS, f"{stream_id(spark, checkpoint)}-{number}")

    query = (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def read_batch(spark: SparkSession, files: DataFrame, schema: str | None = None) -> DataFrame | None:
    """The files of a micro-batch as one table; files of one schema are one scan."""
    groups: dict[str, list[str]] = {}
    for row in parquet_footers(files).select("fingerprint", "path").orderBy("path").collect():
        groups.setdefault(row["fingerprint"], []).append(row["path"])
    if not groups:
        return None
    parts = [
        nested_to_json(spark.read.parquet(*paths).withColumn("_source_file", F.col("_metadata.file_name")))
        for paths in groups.values()
    ]
    if schema is None:
        return union_promoted(parts)
    wanted = T.StructType.fromDDL(schema)
    taken = [
        part.select(
            *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted if f.name in part.columns],
            "_source_file",
        )
        for part in parts
    ]
    types = {f.name: f.dataType for f in wanted} | {"_source_file": T.StringType()}
    result = aligned(taken[0], types)
    for part in taken[1:]:
        result = result.unionAll(aligned(part, types))
    return result


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name that Spark gave the stream when its checkpoint was begun."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
