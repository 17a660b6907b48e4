"""CSV records of files whose headers differ, that begin with other lines, or whose quoted values span lines.

Files are read as lines, in splits. A line begins a record where an even number of quotes lies before it in its file.
Each split counts its quotes and its records for both cases (an even or an odd number before it); the splits before it
tell which case holds. So a quoted line break binds no file to one task: only the lines of records that span lines
are brought together. Columns are found by each file's own header, which is joined to the records as data.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.folder import csv_headers, list_files

QUOTE = '"'


def file_headers(
    spark: SparkSession, path: str | list[str], delimiter: str, encoding: str, skip_rows: int = 0
) -> DataFrame:
    """``file, names``: the fields of the first record after the skipped lines of each file; empty files have none."""
    files = list_files(spark, path, "*").where("length > 0")
    found = csv_headers(files, delimiter, encoding, skip_rows)
    return found.select("file", F.split("fingerprint", "\n").alias("names"))


def csv_lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return spark.read.option("encoding", encoding).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        (quotes % 2).cast("int").alias("odd"),
    )


def has_broken_lines(spark: SparkSession, path: str | list[str], encoding: str) -> bool:
    """Whether any line has an odd number of quotes."""
    return not csv_lines(spark, path, encoding).where("odd = 1").isEmpty()


def numbered_lines(lines: DataFrame, skip_rows: int) -> DataFrame:
    """The lines with ``number`` in their split, and ``even``, ``odd_`` : records begun up to the line in either case.

    A task reads its splits in order, and the skipped lines lie at the head of a file's first split.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # of each split that the task is in: lines, quotes and records so far
        seen: dict[tuple, list[int]] = {}
        for batch in batches:
            parts = []
            for key, some in batch.groupby(["file", "split"], sort=False):
                count, before, even, odd = seen.setdefault(key, [0, 0, 0, 0])
                some = some.assign(number=range(count, count + len(some)))
                seen[key][0] = count + len(some)
                if key[1] == 0:
                    some = some.loc[some["number"] >= skip_rows]
                if some.empty:
                    continue
                sofar = before + some["odd"].cumsum()
                inside = (sofar - some["odd"]) % 2
                some = some.assign(before=inside, even=even + (inside == 0).cumsum(), odd_=odd + (inside == 1).cumsum())
                seen[key][1:] = [int(sofar.iloc[-1]), int(some["even"].iloc[-1]), int(some["odd_"].iloc[-1])]
                parts.append(some)
            if parts:
                yield pd.concat(parts)[columns]

    columns = ["value", "file", "split", "odd", "number", "before", "even", "odd_"]
    return lines.mapInPandas(
        run, "value string, file string, split long, odd int, number long, before int, even long, odd_ long"
    )


def csv_records(spark: SparkSession, path: str | list[str], encoding: str, skip_rows: int, broken: bool) -> DataFrame:
    """``file, record, value``: the records of each file, numbered from 1; broken lines are joined by line feeds."""
    lines = numbered_lines(csv_lines(spark, path, encoding), skip_rows)
    if not broken:
        # as many records as lines; only a file's first record is asked for by number
        first = (F.col("split") == 0) & (F.col("number") == skip_rows)
        return lines.select("file", F.when(first, 1).otherwise(2).alias("record"), "value")
    # a row for each split
    splits = lines.groupBy("file", "split").agg(
        (F.sum("odd") % 2).alias("turns"), F.max("even").alias("begun_even"), F.max("odd_").alias("begun_odd")
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("begun_even")).otherwise(F.col("begun_odd"))
    splits = splits.withColumn("begun", begun)
    splits = splits.select("file", "split", "inside", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("earlier"))
    placed = lines.join(splits, ["file", "split"]).select(
        "file", "split", "number", "value",
        ((F.col("inside") + F.col("before")) % 2 == 0).alias("begins"),
        ((F.col("inside") + F.col("before") + F.col("odd")) % 2 == 0).alias("ends"),
        (F.col("earlier") + F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd_"))).alias("record"),
    )
    whole = placed.where("begins and ends").select("file", "record", "value")
    pieces = placed.where("not (begins and ends)").groupBy("file", "record")
    ordered = F.array_sort(F.collect_list(F.struct("split", "number", "value")))
    return whole.unionAll(pieces.agg(F.array_join(F.transform(ordered, lambda p: p["value"]), "\n").alias("value")))


def read_by_header(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str,
    header: bool,
    encoding: str,
    skip_rows: int,
    broken: bool,
) -> DataFrame:
    """Text columns by the names of each file's header, in order of first appearance; ``_c0`` ... without headers."""
    headers = file_headers(spark, path, delimiter, encoding, skip_rows)
    # a row for each header that occurs
    kinds = headers.groupBy("names").agg(F.min("file").alias("first")).orderBy("first").collect()
    width = max((len(k["names"]) for k in kinds), default=0)
    if not width:
        return spark.createDataFrame([], T.StructType([]))
    records = csv_records(spark, path, encoding, skip_rows, broken).where("trim(value) <> ''")
    fields = ", ".join(f"c{i} string" for i in range(width))
    parsed = records.withColumn("r", F.from_csv("value", fields, {"sep": delimiter, "escape": QUOTE, "maxCharsPerColumn": "-1"}))
    if not header:
        return parsed.select(*[F.col(f"r.c{i}").alias(f"_c{i}") for i in range(width)])
    parsed = parsed.where("record > 1")
    if len(kinds) == 1:
        return parsed.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(kinds[0]["names"])])
    names = list(dict.fromkeys(name for k in kinds for name in k["names"]))
    values = F.array(*[F.col(f"r.c{i}") for i in range(width)])
    found = parsed.join(headers, "file").withColumn("values", values)
    place = lambda name: F.array_position("names", F.lit(name)).cast("int") - 1
    return found.select(*[F.when(place(n) >= 0, F.get("values", place(n))).alias(n) for n in names])
