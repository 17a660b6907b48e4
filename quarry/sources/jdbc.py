"""Relational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

DEFAULT_FETCH_SIZE = 10_000


def jdbc_options(config: dict, table: str) -> dict[str, str]:
    """Reader options of one table.

    ``connection`` gives a ``url`` or host/port/database; ``partition`` (column, lower, upper,
    num) splits the read into parallel range queries.
    """
    connection = config["connection"]
    url = connection.get("url") or "jdbc:{}://{}:{}/{}".format(
        connection.get("driver_scheme", "mysql"),
        connection["host"],
        connection.get("port", 3306),
        connection["database"],
    )
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(config.get("batch_size", DEFAULT_FETCH_SIZE)),
    }
    for key in ("user", "password", "driver"):
        if connection.get(key):
            options[key] = connection[key]
    split = config.get("partition")
    if split:
        options |= {
            "partitionColumn": split["column"],
            "lowerBound": str(split["lower"]),
            "upperBound": str(split["upper"]),
            "numPartitions": str(split["num"]),
        }
    return options


def _reader(spark: SparkSession, config: dict, table: str) -> DataFrameReader:
    return spark.read.format("jdbc").options(**jdbc_options(config, table))


def newer_than(df: DataFrame, incremental: dict | None, last_value: str | None) -> DataFrame:
    """Rows past the high-water mark; the comparison is pushed down to the source.

    Nothing extracted yet means no filter, so early and missing keys are taken by the first run;
    ``start`` in the configuration sets a floor for it.
    """
    mark = last_value if last_value is not None else (incremental or {}).get("start")
    if not incremental or mark is None:
        return df
    key = incremental["key_column"]
    return df.where(F.col(key) > F.lit(mark).cast(df.schema[key].dataType))


def high_water_mark(incremental: dict) -> Column:
    """Aggregate for the largest key extracted, as text for the run log."""
    return F.max(incremental["key_column"]).cast("string")


def read_jdbc_source(
    spark: SparkSession, config: dict, table: str, last_value: str | None = None
) -> DataFrame:
    df = _reader(spark, config, table).load()
    return newer_than(df, config.get("incremental"), last_value)


def jdbc_schema(spark: SparkSession, config: dict, table: str) -> dict[str, str]:
    """Column types; only the table's metadata is queried."""
    return {f.name: f.dataType.simpleString() for f in _reader(spark, config, table).load().schema}
