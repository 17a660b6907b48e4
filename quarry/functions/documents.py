"""JSON text columns: each document is parsed once into a typed struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_object(c: Column, ddl: str) -> Column:
    """Struct of the wanted paths. Text that is not an object yields NULL fields."""
    return F.from_json(c, ddl)


def explode_documents(
    df: DataFrame, array_column: str, ddl: str, into: str = "item", position: str = "posicion"
) -> DataFrame:
    """One row per element of a JSON array; missing and empty arrays give no row.

    Elements are kept as raw text first, so one odd element cannot spoil its neighbours. They are parsed by the
    generator: below it no condition on their fields can be put, which would parse them once more.
    """
    others = [c for c in df.columns if c != array_column]
    elements = F.transform(F.from_json(F.col(array_column), "array<string>"), lambda e: F.from_json(e, ddl))
    return df.select(*others, F.posexplode(elements).alias(position, into))


def computed(df: DataFrame) -> DataFrame:
    """The same rows, for conditions on columns that are costly to compute.

    Spark puts a condition below the projection that computes its operands, and so parses a document once for each
    operand and again for its columns. Below a generator it puts none.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
