"""Raw tables whose columns and types change from batch to batch.

Each batch is written with the schema that the table has by then: the columns so far, types promoted, new columns at
the end. Every such schema is a generation, recorded once in ``_schemas`` beside the data, and a partition of the files
written with it. Reading needs no footer: a generation is one scan with its recorded schema, cast to the newest one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.folder import aligned, merged_types

LOG = "_schemas"
GENERATION, BATCH = "_schema", "_batch"


def schemas(spark: SparkSession, path: str) -> list[T.StructType]:
    """The schemas that a table has had, oldest first; none for a table without a record."""
    try:
        recorded = spark.read.text(f"{path}/{LOG}").collect()  # a row for each change of schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    found = {int(r["generation"]): T.StructType.fromJson(json.loads(r["value"])) for r in recorded}
    return [found[g] for g in sorted(found)]


def write_generation(df: DataFrame, path: str, partitions: list[str], batch: str) -> DataFrame:
    """Add a batch; one that was written before under the same name, wholly or in part, is replaced.

    Returns what was written. ``partitions`` are columns of the batch; they must not differ when it is repeated.
    """
    spark, known = df.sparkSession, schemas(df.sparkSession, path)
    data = [c for c in df.columns if c not in partitions]
    own = df.select(*[F.col(f"`{c}`") for c in data]).schema
    types = merged_types([*known[-1:], own])
    schema = T.StructType([T.StructField(name, kind) for name, kind in types.items()])
    generation = len(known) - 1
    if not known or schema != known[-1]:
        generation += 1
        record = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
        record.write.mode("overwrite").text(f"{path}/{LOG}/generation={generation}")
    marks = {GENERATION: F.lit(generation), BATCH: F.lit(batch)}
    written = aligned(df, types, [*[F.col(p) for p in partitions], *[v.alias(k) for k, v in marks.items()]])
    (
        written.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions, GENERATION, BATCH)
        .parquet(path)
    )
    return written


def read_generations(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame | None:
    """All batches in the newest schema, with their partition columns (integers); None without a record."""
    known = schemas(spark, path)
    if not known:
        return None
    newest = {f.name: f.dataType for f in known[-1]}
    keys = [T.StructField(p, T.IntegerType()) for p in (*partitions, GENERATION)] + [T.StructField(BATCH, T.StringType())]
    parts = []
    for generation, schema in enumerate(known):
        stored = spark.read.schema(T.StructType([*schema, *keys])).parquet(path)
        one = stored.where(F.col(GENERATION) == generation)
        parts.append(aligned(one, newest, [F.col(f.name) for f in keys]))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionAll(part)
    return table
