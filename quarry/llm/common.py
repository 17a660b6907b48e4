"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a corpus are large: what a Python worker and its executor hold at once is bounded by this.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for large rows; the session may set smaller ones."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(f"spark.sql.execution.arrow.{key}", None)
        if now is None or not str(now).isdigit() or not 0 < int(now) <= most:
            conf.set(f"spark.sql.execution.arrow.{key}", str(most))

    def run(batches):
        yield from function(batches)
        # the worker stays for later tasks; what this one held goes back to the system
        gc.collect()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column of the batch, or else a field of its struct ``carried``: so a text is sent once."""
    return batch.column(column) if column in batch.schema.names else batch.column("carried").field(column)


def blobs(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    return [value or b"" for value in texts(batch, column).cast(pa.binary()).to_pylist()]


def row_numbers() -> Iterator[int]:
    """Numbers that no other task of the stage gives; a task run again gives the same ones."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    while True:
        yield number
        number += 1


def carried(df: DataFrame, columns: list[str]) -> F.Column:
    """The named columns in one struct, so that no name of theirs meets one of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.struct(F.lit(None).alias("none"))


def uncarried(columns: list[str], struct: str = "carried") -> list[F.Column]:
    return [F.col(f"{struct}.`{c}`").alias(c) for c in columns]


def ddl(df: DataFrame, column: str) -> str:
    """The type of a column as text, for the schema of a Python operator."""
    return df.schema[column].dataType.simpleString()
