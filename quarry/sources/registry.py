"""Readers by source type; projects add their own with ``register_source``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.csv import read_csv_source
from quarry.sources.folder import all_columns, read_folder
from quarry.sources.jdbc import newer_than, read_jdbc_source

Reader = Callable[..., DataFrame]


def _read_parquet_source(
    spark: SparkSession, config: dict, table: str, last_value: str | None = None
) -> DataFrame:
    """Parquet tables named in ``tables`` or found below ``path`` by table name."""
    paths = {t["name"]: t["path"] for t in config.get("tables", []) if isinstance(t, dict)}
    df = all_columns(spark).parquet(paths.get(table) or f"{config['path']}/{table}")
    return newer_than(df, config.get("incremental"), last_value)


def _read_folder_source(
    spark: SparkSession, config: dict, table: str, last_value: str | None = None
) -> DataFrame:
    folder = config["folders"][table]
    df = read_folder(spark, folder["path"], folder.get("format", "parquet"))
    if df is None:
        raise FileNotFoundError(f"no {folder.get('format', 'parquet')} files in {folder['path']}")
    return df


_READERS: dict[str, Reader] = {
    "csv": read_csv_source,
    "jdbc": read_jdbc_source,
    "mysql": read_jdbc_source,
    "parquet": _read_parquet_source,
    "folder": _read_folder_source,
}


def register_source(kind: str, reader: Reader) -> None:
    """``reader(spark, config, table, last_value=None) -> DataFrame``"""
    _READERS[kind] = reader


def read_source(
    spark: SparkSession, config: dict, table: str, last_value: str | None = None
) -> DataFrame:
    """Extract one table and add the lineage columns."""
    kind = config["type"]
    if kind not in _READERS:
        raise ValueError(f"unknown source type {kind!r}; available: {', '.join(sorted(_READERS))}")
    df = _READERS[kind](spark, config, table, last_value=last_value)
    return with_lineage(df, config["name"])


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Add the ingestion time and the source name."""
    return df.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source_name": F.lit(source)}
    )


def table_names(config: dict) -> list[str]:
    """Tables of a source; a source without a list is one table named like itself."""
    if config.get("folders"):
        return list(config["folders"])
    tables = [t["name"] if isinstance(t, dict) else str(t) for t in config.get("tables", [])]
    return tables or [config["name"]]
