"""Data-quality checks as DataFrames.

Row-level checks of a table share one aggregation; each uniqueness check adds one grouped
aggregation of its own, which keeps repeated keys from being expanded or gathered.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.joins import keep_unmatched

log = logging.getLogger(__name__)

KNOWN_CHECKS = (
    "not_null", "unique", "valid_values", "accepted_values", "range", "relationships", "expression",
)
#: Checks that look at one row at a time.
ROW_CHECKS = ("not_null", "valid_values", "accepted_values", "range", "expression")
RESULT_COLUMNS = ["position", "check", "columns", "failing_rows", "passed", "details", "severity"]


@dataclass(frozen=True)
class _Measure:
    """One number to measure and how to word it."""

    position: int
    check: str
    columns: str
    severity: str
    wording: str
    condition: Column | None = None


def failing_condition(df: DataFrame, check: dict) -> Column | None:
    """Row predicate that is true on violations, or None when the check is not row-level."""
    kind = check["type"]
    if kind == "not_null":
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in check["columns"]])
    if kind in ("valid_values", "accepted_values"):
        # compared as the column's own type; a value that it cannot hold allows nothing
        column = F.col(check["column"])
        kind_of = df.select(column).schema[0].dataType
        allowed = F.array_compact(F.array(*[_as_type(v, kind_of) for v in check["values"]]))
        return ~F.array_contains(allowed, column)
    if kind == "range":
        tests = []
        if check.get("min_value") is not None:
            tests.append(F.col(check["column"]) < F.lit(check["min_value"]))
        if check.get("max_value") is not None:
            tests.append(F.col(check["column"]) > F.lit(check["max_value"]))
        return reduce(lambda a, b: a | b, tests, F.lit(False))
    if kind == "expression":
        return ~F.expr(check["condition"])
    return None


def _as_type(value: object, kind: T.DataType) -> Column:
    """The value in this type; NULL where the type has no such value (1.5 among whole numbers)."""
    held = F.lit(value).try_cast(kind)
    if isinstance(kind, T.NumericType) and isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return F.when(held == F.lit(value), held)
    return held


def run_checks(
    df: DataFrame, checks: list[dict], references: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Result rows (position, check, columns, failing_rows, passed, details, severity).

    A not_null check over several columns reports each failing column in its details; an
    unknown check type has no count and is failed. ``references`` holds the parents of relationship
    checks ({type: relationships, column, to, field}).
    """
    measures: list[_Measure] = []
    separate: list[DataFrame] = []
    for position, check in enumerate(checks):
        kind, severity = check["type"], check.get("severity", "warn")
        names = check.get("columns") or [check.get("column", "")]
        label = ", ".join(names)
        if kind == "not_null":
            for name in names:
                measures.append(
                    _Measure(position, kind, label, severity, f"{name} is missing in %s rows", F.col(name).isNull())
                )
        elif kind == "unique":
            wording = f"%s rows repeat a key of ({label})"
            separate.append(
                _measured(duplicate_count(df, names), position, kind, label, severity, wording)
            )
        elif kind == "relationships":
            parent = (references or {})[check["to"]]
            orphans = orphan_rows(df, check["column"], parent, check["field"])
            wording = f"%s rows have a {label} that {check['to']} lacks"
            separate.append(
                _measured(
                    orphans.agg(F.count(F.lit(1)).alias("n")), position, kind, label, severity, wording
                )
            )
        else:
            condition = failing_condition(df, check)
            wording = {
                "valid_values": f"{label} is not an allowed value in %s rows",
                "accepted_values": f"{label} is not an allowed value in %s rows",
                "range": f"{label} is outside its limits in %s rows",
                "expression": f"{check.get('condition')} does not hold in %s rows",
            }.get(kind, "no check of this type")
            if condition is None:
                log.warning("unknown quality check %r", kind)
            measures.append(_Measure(position, kind, label, severity, wording, condition))

    parts = separate
    if measures:
        parts = [_row_level(df, measures), *separate]
    counted = reduce(DataFrame.unionByName, parts)
    # at most one row per check and column from here on
    word = F.replace("wording", F.lit("%s"), F.coalesce(F.col("n").cast("string"), F.lit("")))
    failed = F.coalesce(F.col("n") > 0, F.lit(True))
    grouped = counted.groupBy("position", "check", "columns", "severity").agg(
        F.sum("n").alias("failing_rows"),
        (F.count_if(failed) == 0).alias("passed"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(failed, F.struct("item", word.alias("word"))))),
                lambda s: s["word"],
            ),
            ", ",
        ).alias("failures"),
    )
    details = F.when(F.col("passed"), F.lit("passed")).otherwise(F.col("failures"))
    return grouped.withColumn("details", details).select(*RESULT_COLUMNS)


def _row_level(df: DataFrame, measures: list[_Measure]) -> DataFrame:
    aggregates = [
        (F.count_if(m.condition) if m.condition is not None else F.lit(None).cast("bigint")).alias(
            f"m{i}"
        )
        for i, m in enumerate(measures)
    ]
    one_row = df.agg(F.count(F.lit(1)).alias("all_rows"), *aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(m.position).alias("position"),
                F.lit(m.check).alias("check"),
                F.lit(m.columns).alias("columns"),
                F.lit(m.severity).alias("severity"),
                F.lit(m.wording).alias("wording"),
                F.lit(i).alias("item"),
                F.col(f"m{i}").alias("n"),
            )
            for i, m in enumerate(measures)
        ]
    )
    return one_row.select(F.inline(rows))


def _measured(
    one_row: DataFrame, position: int, check: str, columns: str, severity: str, wording: str
) -> DataFrame:
    return one_row.select(
        F.lit(position).alias("position"),
        F.lit(check).alias("check"),
        F.lit(columns).alias("columns"),
        F.lit(severity).alias("severity"),
        F.lit(wording).alias("wording"),
        F.lit(0).alias("item"),
        F.col("n").cast("bigint").alias("n"),
    )


def duplicate_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows minus distinct keys. A single NULL key is no key; in a composite key it counts."""
    sizes = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("size"))
    keys = F.count(columns[0]) if len(columns) == 1 else F.count(F.lit(1))
    return sizes.agg((F.coalesce(F.sum("size"), F.lit(0)) - keys).alias("n"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """min, max, total, nulls and distinct of one column, via its distinct values."""
    sizes = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct"),
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    return keep_unmatched(child.where(F.col(column).isNotNull()), parent, column, field)


def failing_rows(
    df: DataFrame, check: dict, references: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The rows that violate a check, for a quarantine table."""
    kind = check["type"]
    if kind == "unique":
        columns = check["columns"]
        repeated = (
            df.groupBy(*[F.col(c).alias(f"__u_{c}") for c in columns])
            .agg(F.count(F.lit(1)).alias("__size"))
            .where("__size > 1")
            .drop("__size")
        )
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__u_{c}")) for c in columns]
        )
        return df.join(repeated, same, "left_semi")
    if kind == "relationships":
        return orphan_rows(df, check["column"], (references or {})[check["to"]], check["field"])
    condition = failing_condition(df, check)
    if condition is None:
        raise ValueError(f"no failing rows for check type {kind!r}")
    return df.where(F.coalesce(condition, F.lit(False)))


class QualityGateError(RuntimeError):
    """A check with severity 'error' failed."""


def severity_gate(results: DataFrame, on_warn: Callable[[str], None] | None = None) -> list[dict]:
    """Raise when an 'error' check failed, log the failed 'warn' checks, return all results.

    The result table has one row per configured check, so collecting it is bounded.
    """
    rows = [r.asDict() for r in results.orderBy("position").collect()]
    failed = [r for r in rows if not r["passed"]]
    for r in failed:
        if r["severity"] != "error":
            (on_warn or log.warning)(f"{r['check']}: {r['details']}")
    errors = [f"{r['check']}: {r['details']}" for r in failed if r["severity"] == "error"]
    if errors:
        raise QualityGateError("; ".join(errors))
    return rows


# --- business rules -------------------------------------------------------------------


def subtotal_mismatch(
    lines: DataFrame,
    quantity: str = "cantidad",
    price: str = "precio_unitario",
    discount: str = "descuento",
    subtotal: str = "subtotal",
    tolerance: float = 1.0,
    discount_kind: str = "amount",
) -> DataFrame:
    """Lines whose subtotal differs from quantity * price less the discount."""
    gross = F.col(quantity) * F.col(price)
    off = F.coalesce(F.col(discount), F.lit(0))
    expected = gross - off if discount_kind == "amount" else gross * (F.lit(1) - off)
    gap = F.abs(F.col(subtotal) - expected)
    return lines.where(gap > F.lit(tolerance)).withColumns(
        {"subtotal_calculado": F.round(expected, 2), "diferencia": F.round(gap, 2)}
    )


def net_amount_mismatch(
    settlements: DataFrame, gross: str, net: str, deductions: list[str], tolerance: float = 0.10
) -> DataFrame:
    """Settlements whose net is not the gross less every deduction."""
    expected = reduce(lambda a, b: a - b, [F.col(d) for d in deductions], F.col(gross))
    gap = F.abs(F.col(net) - expected)
    return settlements.where(gap > F.lit(tolerance)).withColumns(
        {"neto_calculado": F.round(expected, 2), "diferencia": F.round(gap, 2)}
    )


def orders_without_items(orders: DataFrame, items: DataFrame, order_id: str, item_order_id: str) -> DataFrame:
    return keep_unmatched(orders.select(order_id), items, order_id, item_order_id, unique=True)


def price_below_cost(products: DataFrame, price: str, cost: str) -> DataFrame:
    return products.where(F.col(price) < F.col(cost))


def event_before_parent(
    events: DataFrame, parents: DataFrame, event_key: str, parent_key: str, event_date: str, parent_date: str
) -> DataFrame:
    """Events dated before the record they belong to, with the days between."""
    joined = events.join(parents, F.col(event_key) == F.col(parent_key))
    return joined.where(F.col(event_date) < F.col(parent_date)).withColumn(
        "dias_de_diferencia", F.datediff(parent_date, event_date)
    )
