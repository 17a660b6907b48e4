"""Folders of files whose schemas disagree, read into one table."""

from __future__ import annotations

import codecs
import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.StructType, T.ArrayType, T.MapType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """(path, length, file) of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", F.col("_metadata.file_path").alias("file"))
    )


def all_columns(spark: SparkSession) -> DataFrameReader:
    """A reader of the columns of all files, not only of the one that Spark looks at."""
    return spark.read.option("mergeSchema", "true")


def has_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> bool:
    try:
        return not list_files(spark, folder, pattern).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def open_location(path: str):
    """(file system, path) for a location as Spark prints it; used inside tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def parquet_footers(files: DataFrame) -> DataFrame:
    """Rows, row groups, columns, codec and a schema fingerprint per file, from footers only."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path, length in zip(batch["path"], batch["length"]):
                system, location = open_location(path)
                footer = pq.read_metadata(location, filesystem=system)
                schema = footer.schema.to_arrow_schema().remove_metadata()
                codec = (
                    footer.row_group(0).column(0).compression
                    if footer.num_row_groups and footer.num_columns
                    else ""
                )
                found.append(
                    (path, length, footer.num_rows, footer.num_row_groups, len(schema), codec,
                     "\n".join(f"{f.name}: {f.type}" for f in schema))
                )
            yield pd.DataFrame(
                found, columns=["path", "bytes", "rows", "row_groups", "columns", "codec", "fingerprint"]
            )

    return files.mapInPandas(
        read,
        "path string, bytes bigint, rows bigint, row_groups bigint, columns bigint,"
        " codec string, fingerprint string",
    )


def csv_headers(files: DataFrame, delimiter: str, encoding: str = "utf-8", skip_rows: int = 0) -> DataFrame:
    """The column names in each file's first record after the skipped lines; no more than that is read.

    ``file`` is the name that ``_metadata.file_path`` has for the file.
    """
    kind = "utf-8-sig" if encoding.lower() in ("utf-8", "utf8") else encoding

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, file in zip(batch["path"], batch["file"]):
                system, location = open_location(path)
                with system.open_input_file(location) as stream:
                    decode = codecs.getincrementaldecoder(kind)().decode
                    head, line = "", None
                    while line is None:
                        piece = stream.read(1 << 16)
                        head += decode(piece, not piece)
                        line = _record_after(head, skip_rows, not piece)
                names = next(csv.reader([line], delimiter=delimiter), []) if line else []
                found.append((path, file, "\n".join(n.replace("\n", " ") for n in names)))
            yield pd.DataFrame(found, columns=["path", "file", "fingerprint"])

    named = files.select("path", "file") if "file" in files.columns else files.select("path", F.col("path").alias("file"))
    return named.mapInPandas(read, "path string, file string, fingerprint string")


def _record_after(text: str, lines: int, complete: bool) -> str | None:
    """The record after so many lines, without its line end; None where the text does not reach to its end."""
    rest = text
    for _ in range(lines):
        _, found, rest = rest.partition("\n")
        if not found:
            return "" if complete else None
    end = rest.find("\n")
    while end >= 0 and rest.count('"', 0, end) % 2:
        end = rest.find("\n", end + 1)
    if end < 0:
        return rest.strip("\r\n") if complete else None
    return rest[:end].strip("\r")


def same_schema_groups(described: DataFrame) -> list[list[str] | None]:
    """Paths by schema, ordered by first path; None alone when all files agree.

    Only folders with conflicting schemas need their file names on the driver, where Spark
    plans the scan of any folder from them.
    """
    groups = described.groupBy("fingerprint").agg(F.min("path").alias("first"))
    if len(groups.limit(2).collect()) < 2:
        return [None]
    paths: dict[str, list[str]] = {}
    for row in described.select("fingerprint", "path").orderBy("path").collect():
        paths.setdefault(row["fingerprint"], []).append(row["path"])
    return list(paths.values())


def common_type(kinds: set[T.DataType]) -> T.DataType:
    """One type for a column that files give these types: theirs if they agree, a double if all
    are numbers, else text. Files in which a column has nothing have no say."""
    known = kinds - {T.NullType()}
    if len(known) < 2:
        return next(iter(known), T.NullType())
    return T.DoubleType() if all(isinstance(k, _NUMERIC) for k in known) else T.StringType()


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text; null fields are kept, null stays null."""
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, _NESTED)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def merged_types(schemas: list[T.StructType]) -> dict[str, T.DataType]:
    """Columns of all schemas in order of first appearance, with types that hold all values.

    A column that is nothing but NULL so far has no type and is left out.
    """
    found: dict[str, set[T.DataType]] = {}
    for schema in schemas:
        for field in schema:
            found.setdefault(field.name, set()).add(field.dataType)
    types = {name: common_type(kinds) for name, kinds in found.items()}
    return {name: kind for name, kind in types.items() if kind != T.NullType()}


def aligned(df: DataFrame, types: dict[str, T.DataType], more: list[Column] = ()) -> DataFrame:
    """The columns in these types, NULL where the table lacks one, and ``more`` columns after them."""
    return df.select(
        *[(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in types.items()], *more
    )


def union_promoted(parts: list[DataFrame]) -> DataFrame:
    """Union by name: columns in order of first appearance, types promoted, gaps NULL."""
    types = merged_types([part.schema for part in parts])
    result = aligned(parts[0], types)
    for part in parts[1:]:
        result = result.unionAll(aligned(part, types))
    return result


def read_folder(
    spark: SparkSession, folder: str, file_format: str = "parquet", delimiter: str = ",",
    base_path: str | None = None,
) -> DataFrame | None:
    """All files below a folder as one table with ``_source_file``; None when it is empty.

    Files are grouped by schema in a distributed pass over footers or header lines; each
    group is one ordinary scan, so thousands of daily files stay a handful of reads.
    """
    pattern = f"*.{file_format}"
    if not has_files(spark, folder, pattern):
        return None
    files = list_files(spark, folder, pattern)
    described = parquet_footers(files) if file_format == "parquet" else csv_headers(files, delimiter)
    parts = []
    for paths in same_schema_groups(described):
        reader = spark.read
        if base_path:
            reader = reader.option("basePath", base_path)
        elif paths is None:
            reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        if file_format == "parquet":
            part = reader.parquet(*(paths or [folder]))
        else:
            part = reader.options(header=True, sep=delimiter).csv(paths or folder)
        named = part.withColumn("_source_file", F.col("_metadata.file_name"))
        parts.append(nested_to_json(named))
    table = union_promoted(parts)
    # values as they stand in the files decide, not what one group of files looks like
    from quarry.sources.csv import narrow_text  # reads headers by this module

    return table if file_format == "parquet" else narrow_text(table, keep=("_source_file",))
