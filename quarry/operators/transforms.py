"""Declarative steps: each builds a function DataFrame -> DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.casts import strict_cast
from quarry.functions.keys import joined_key
from quarry.operators.dedup import best_row

log = logging.getLogger(__name__)
Step = Callable[[DataFrame], DataFrame]


def rename(columns: dict[str, str]) -> Step:
    """Renamed columns come first, the others follow in order."""

    def apply(df: DataFrame) -> DataFrame:
        _require(df, columns, "rename")
        renamed = [F.col(old).alias(new) for old, new in columns.items()]
        return df.select(*renamed, *[c for c in df.columns if c not in columns])

    return apply


def cast(columns: dict[str, str]) -> Step:
    """Strict casts, cast columns first; a value that does not convert is an error."""

    def apply(df: DataFrame) -> DataFrame:
        _require(df, columns, "cast")
        casts = [
            strict_cast(F.col(c), df.schema[c].dataType, t).alias(c) for c, t in columns.items()
        ]
        return df.select(*casts, *[c for c in df.columns if c not in columns])

    return apply


def where(condition: str) -> Step:
    return lambda df: df.where(F.expr(condition))


def deduplicate(keys: list[str], order_by: list[str] | None = None) -> Step:
    """One row per key; newest ingestion first unless an order such as 'ts DESC' is given."""
    if not keys:
        raise ValueError("deduplicate needs keys")
    orders = order_by or ["_ingestion_timestamp DESC"]

    def apply(df: DataFrame) -> DataFrame:
        return best_row(df, list(keys), [_sort_key(o) for o in orders])

    return apply


def custom_sql(sql: str) -> Step:
    """User SQL in which __INPUT__ names the previous step."""

    def apply(df: DataFrame) -> DataFrame:
        text = sql.replace("{", "{{").replace("}", "}}").replace("__INPUT__", "{step_input}")
        return df.sparkSession.sql(text, step_input=df)

    return apply


def aggregate(group_by: list[str], aggregations: list[str]) -> Step:
    """GROUP BY plus SQL aggregate expressions such as 'SUM(total) AS amount'."""

    def apply(df: DataFrame) -> DataFrame:
        return df.groupBy(*group_by).agg(*[F.expr(a) for a in aggregations])

    return apply


def date_parts(column: str) -> Step:
    """Add year, month, day and day of week (Sunday = 0)."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                f"{column}_year": F.year(column),
                f"{column}_month": F.month(column),
                f"{column}_day": F.dayofmonth(column),
                f"{column}_dow": F.dayofweek(column) - 1,
            }
        )

    return apply


def hash_key(columns: list[str], name: str = "hash_key") -> Step:
    return lambda df: df.withColumn(name, joined_key([F.col(c) for c in columns]))


def drop_internal(df: DataFrame, created: list[str]) -> DataFrame:
    """Remove the helper columns that steps have created; a column of the user's stays, whatever its name."""
    return df.drop(*created)


BUILDERS: dict[str, Callable[[dict], Step]] = {
    "rename": lambda s: rename(_columns(s)),
    "cast": lambda s: cast(_columns(s)),
    "filter": lambda s: where(s["condition"]),
    "deduplicate": lambda s: deduplicate(s["keys"], s.get("order_by")),
    "custom_sql": lambda s: custom_sql(s["sql"]),
    "aggregate": lambda s: aggregate(s["group_by"], s["aggregations"]),
    "date_parts": lambda s: date_parts(s["column"]),
    "hash_key": lambda s: hash_key(s["columns"], s.get("key_name", "hash_key")),
}


def build_steps(specs: list[dict], unknown: str = "warn") -> list[Step]:
    """Steps from configuration; an unknown type is skipped with a warning or an error."""
    steps = []
    for spec in specs:
        builder = BUILDERS.get(spec["type"])
        if builder is not None:
            steps.append(builder(spec))
        elif unknown == "error":
            raise ValueError(f"unknown step {spec['type']!r}; known: {sorted(BUILDERS)}")
        else:
            log.warning("unknown step %r skipped", spec["type"])
    return steps


def transform_chain(df: DataFrame, specs: list[dict], unknown: str = "warn") -> DataFrame:
    """All steps in order; a step's ``helpers`` are columns that later steps use and the result lacks."""
    chained = reduce(lambda d, step: d.transform(step), build_steps(specs, unknown), df)
    return drop_internal(chained, [name for spec in specs for name in spec.get("helpers", [])])


def _columns(spec: dict) -> dict[str, str]:
    columns = spec.get("columns")
    if not isinstance(columns, dict) or not columns:
        raise ValueError(f"{spec['type']} needs a 'columns' mapping")
    return columns


def _require(df: DataFrame, columns: dict[str, str], step: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{step}: no such columns {missing}; have {df.columns}")


def _sort_key(text: str):
    name, _, direction = text.strip().partition(" ")
    column = F.expr(name)
    return column.desc_nulls_last() if direction.upper().startswith("DESC") else column.asc_nulls_last()
