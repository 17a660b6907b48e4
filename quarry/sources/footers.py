"""The files of a table with their schemas, kept in ``_files`` beside them so that a footer is read once.

A file is known by path, length and time of change. Recording adds the files that are not known yet, in a distributed pass
over their footers; reading the list opens the footers of unrecorded files only and writes nothing. Files that are gone
stay in the record and are passed over; two records of one file are one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import materialise
from quarry.sources.folder import aligned, merged_types, nested_to_json, parquet_footers

LOG = "_files"
KEY = ["path", "length", "modificationTime"]
_RECORD = "path string, length bigint, modificationTime timestamp, schema string"
_LISTED = 4  # columns of a listing before those of the partitions


def listing(spark: SparkSession, folder: str) -> DataFrame | None:
    """The data files of a table and the partition columns that their paths have; None without a folder."""
    try:
        return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).drop("content")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(_RECORD).parquet(f"{folder}/{LOG}").dropDuplicates(KEY)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _RECORD)
        raise


def unrecorded(files: DataFrame, known: DataFrame) -> DataFrame | None:
    """The files that the record lacks, with their schemas; None if it lacks none."""
    spark = files.sparkSession
    fresh = files.select(*KEY).join(known, KEY, "left_anti")
    if fresh.isEmpty():
        return None
    footers = materialise(fresh.join(parquet_footers(fresh.select("path", "length")).select("path", "fingerprint"), "path"), "footers")
    kinds = footers.groupBy("fingerprint").agg(F.min("path").alias("path")).collect()  # a row for each schema
    schemas = [(kind["fingerprint"], spark.read.parquet(kind["path"]).schema.json()) for kind in kinds]
    return footers.join(spark.createDataFrame(schemas, "fingerprint string, schema string"), "fingerprint").select(*KEY, "schema")


def record(spark: SparkSession, folder: str) -> None:
    """Add the files that are not recorded yet."""
    files = listing(spark, folder)
    fresh = None if files is None else unrecorded(files, recorded(spark, folder))
    if fresh is not None:
        fresh.coalesce(1).write.mode("append").parquet(f"{folder}/{LOG}")


def read_recorded(spark: SparkSession, folder: str, lenient: bool = False, wanted: Column | None = None) -> DataFrame | None:
    """A table with the columns of all its files and its partition columns; None without files.

    No footer of a recorded file is opened. Where the files' types differ, ``lenient`` promotes them (as a folder read
    does) and is an error otherwise. ``wanted`` is a condition on partition columns: with several schemas, only files
    of these partitions have their paths on the driver, where Spark plans the scan of each schema.
    """
    files = listing(spark, folder)
    if files is None:
        return None
    partitions = files.schema.fields[_LISTED - 1 :]
    known = recorded(spark, folder)
    fresh = unrecorded(files, known)
    described = files.join(known if fresh is None else known.unionByName(fresh), KEY)
    texts = described.groupBy("schema").agg(F.min("path").alias("first")).orderBy("first").collect()  # a row for each schema
    if not texts:
        return None
    schemas = {row["schema"]: T.StructType.fromJson(json.loads(row["schema"])) for row in texts}
    if not lenient:
        merged: dict[str, T.DataType] = {}
        for schema in schemas.values():
            for field in schema:
                if merged.setdefault(field.name, field.dataType) != field.dataType:
                    raise ValueError(
                        f"{folder}: column {field.name!r} is {merged[field.name].simpleString()} in some files and"
                        f" {field.dataType.simpleString()} in others; read it with lenient=True"
                    )
        columns = [T.StructField(name, kind) for name, kind in merged.items()]
        return spark.read.schema(T.StructType([*columns, *partitions])).parquet(folder)
    if wanted is not None:
        described = described.where(wanted)
    paths: dict[str, list[str]] = {text: [folder] for text in schemas}
    if len(schemas) > 1:
        paths = {text: [] for text in schemas}
        for row in described.select("schema", "path").orderBy("path").collect():
            paths[row["schema"]].append(row["path"])
    parts = []
    for text, schema in schemas.items():
        whole = T.StructType([*schema, *partitions])
        if paths[text]:
            part = spark.read.schema(whole).option("basePath", folder).parquet(*paths[text])
        else:  # its columns count, though none of its files is wanted
            part = spark.createDataFrame([], whole)
        name = F.col("_metadata.file_name") if paths[text] else F.lit(None).cast("string")
        parts.append(nested_to_json(part.withColumn("_source_file", name)))
    types = merged_types([part.schema for part in parts])
    table = aligned(parts[0], types)
    for part in parts[1:]:
        table = table.unionAll(aligned(part, types))
    return table
