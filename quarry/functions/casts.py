"""Lenient and strict conversions with the semantics of the staging models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL type names accepted by the cast step, and the Spark type of each.
TYPE_NAMES = {
    "VARCHAR": "string",
    "TEXT": "string",
    "INTEGER": "int",
    "INT": "int",
    "SMALLINT": "smallint",
    "BIGINT": "bigint",
    "HUGEINT": "decimal(38,0)",
    "FLOAT": "float",
    "REAL": "float",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp",
    "BLOB": "binary",
}

INTEGRAL = ("tinyint", "smallint", "int", "bigint")

# All texts that convert to a type have its form (numbers are decimal, hexadecimal, or a word).
_BLANK = r"[\x00-\x20\x7f]*"
FORMS = {
    "int": rf"^{_BLANK}[+-]?0*[0-9]{{0,10}}{_BLANK}$",
    "bigint": rf"^{_BLANK}[+-]?0*[0-9]{{0,19}}{_BLANK}$",
    "double": rf"(?i)^{_BLANK}[+-]?(?:[0-9]*\.?[0-9]*(?:e[+-]?[0-9]+)?[fd]?|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[fd]?"
    rf"|nan|inf|infinity){_BLANK}$",
    "boolean": rf"(?i)^{_BLANK}(?:t|true|y|yes|1|f|false|n|no|0){_BLANK}$",
}


def spark_type(name: str) -> str:
    return TYPE_NAMES.get(name.strip().upper(), name.strip().lower())


def try_text(c: Column, target: str) -> Column:
    """A text in this type or NULL.

    A text that does not convert costs an exception in the cast, far more than all else done with its row, so such texts
    are told by their form first.
    """
    return F.when(c.rlike(FORMS[target]), c.try_cast(target)) if target in FORMS else c.try_cast(target)


def try_double(c: Column) -> Column:
    """Double or NULL, of any type."""
    return F.when((F.typeof(c) != "string") | c.cast("string").rlike(FORMS["double"]), c.try_cast("double"))


def try_int(c: Column) -> Column:
    """Integer or NULL; a fractional text such as '2.7' rounds half away from zero."""
    return F.round(try_double(c)).try_cast("int")


def try_timestamp(c: Column) -> Column:
    """Wall-clock timestamp or NULL; an offset in the text is ignored."""
    return c.try_cast("timestamp_ntz")


def strict_cast(c: Column, source: T.DataType, target: str) -> Column:
    """Cast that fails on a bad value; fractions are rounded into integers, not cut off."""
    wanted = spark_type(target)
    if wanted in INTEGRAL:
        if isinstance(source, (T.DoubleType, T.FloatType)):
            return F.rint(c).cast(wanted)
        if isinstance(source, (T.StringType, T.DecimalType)):
            return F.round(c.cast("decimal(38,10)")).cast(wanted)
    return c.cast(wanted)


def from_cents(c: Column) -> Column:
    return try_double(c) / F.lit(100.0)


def coordinate(c: Column) -> Column:
    """Latitude or longitude; zero stands for unknown."""
    return F.nullif(try_double(c), F.lit(0.0))


def country_code(c: Column) -> Column:
    return F.when(c == "ARG", F.lit("AR")).otherwise(c)


def bool_flag(c: Column) -> Column:
    """0/1, S/N and their longer spellings as boolean; anything else is NULL."""
    text = F.upper(F.trim(c.cast("string")))
    return F.when(text.isin("1", "S", "SI", "TRUE"), F.lit(True)).when(
        text.isin("0", "N", "NO", "FALSE"), F.lit(False)
    )


def clean_status(c: Column) -> Column:
    return F.upper(F.trim(c))
