from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.plans import analytics


@pytest.fixture
def orders(spark):
    data = [
        (1, "Alice", Decimal("150.00"), "2024-01-15", "COMPLETED"),
        (2, "Bob", Decimal("75.50"), "2024-01-16", "COMPLETED"),
        (3, "Alice", Decimal("200.00"), "2024-01-20", "CANCELLED"),
        (4, "Charlie", Decimal("50.00"), "2024-02-01", "COMPLETED"),
        (5, "Alice", Decimal("300.00"), "2024-02-15", "COMPLETED"),
        (6, "Bob", Decimal("125.00"), "2024-03-01", "PENDING"),
        (7, "Diana", Decimal("500.00"), "2024-03-10", "COMPLETED"),
    ]
    df = spark.createDataFrame(data, "id int, customer string, total decimal(5,2), day string, status string")
    return df.withColumn("order_date", F.col("day").cast("date"))


def test_segments(orders):
    out = analytics.customer_segments(orders, "customer", "status", "total", "order_date", "COMPLETED")
    found = {r["customer"]: (float(r["total_spent"]), float(r["avg_order"]), r["segment"]) for r in out.collect()}
    assert found == {
        "Diana": (500.0, 500.0, "VIP"), "Alice": (450.0, 225.0, "VIP"),
        "Bob": (75.5, 75.5, "New"), "Charlie": (50.0, 50.0, "New"),
    }


def test_completion(orders):
    out = analytics.monthly_completion(orders, "order_date", "status", "total", "COMPLETED").orderBy("month")
    assert [(r["orders"], r["completed"], float(r["revenue"]), r["completion_rate_pct"]) for r in out.collect()] == [
        (3, 2, 225.5, 66.7), (2, 2, 350.0, 100.0), (2, 1, 500.0, 50.0),
    ]


def test_product_summary(spark):
    data = [
        (1, "Alice", "Widget A", 2, 10.5), (2, "Bob", "Widget B", 1, 25.0), (3, "Alice", "Widget A", 3, 10.5),
        (4, "Charlie", "Widget C", 1, 50.0), (5, "Bob", "Widget A", 5, 10.5), (6, "Diana", "Widget B", 2, 25.0),
        (7, "Alice", "Widget C", 1, 50.0), (8, "Eve", "Widget A", 10, 10.5),
    ]
    df = spark.createDataFrame(data, "id int, cliente string, producto string, cantidad int, precio double")
    out = analytics.product_summary(
        df, "producto", F.col("cantidad"), F.col("cantidad") * F.col("precio"), "cliente"
    )
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {
        "Widget A": (20, 210.0, 3), "Widget C": (2, 100.0, 2), "Widget B": (3, 75.0, 2),
    }


def test_fx_rounds_ties_exactly(spark):
    arg = spark.createDataFrame(
        [("ARG-001", "2024-01-15", "ARG", "AMOX500", 100, 850.50, "ARS"), ("ARG-002", "2024-01-15", "ARG", "IBUP400", 200, 320.0, "ARS"),
         ("ARG-003", "2024-02-01", "ARG", "AMOX500", 50, 870.0, "ARS")],
        "invoice_id string, fecha string, pais string, producto_cod string, cantidad int, precio_unit double, moneda string",
    )
    bra = spark.createDataFrame(
        [("BRA-001", "2024-01-20", "BRA", "AMOX500", 80, 45.90, "BRL"), ("BRA-002", "2024-01-22", "BRA", "IBUP400", 150, 18.50, "BRL")],
        "invoice_id string, fecha string, pais string, producto_cod string, cantidad int, precio_unit double, moneda string",
    )
    products = spark.createDataFrame([("AMOX500", "Amoxicilina")], "producto_cod string, nombre string")
    rates = spark.createDataFrame([("ARS", "0.0011"), ("BRL", "0.20")], "moneda string, a_usd string")
    out = {r["invoice_id"]: r for r in analytics.fx_consolidation([arg, bra], products, rates).collect()}
    assert {k: str(r["venta_total_usd"]) for k, r in out.items()} == {
        "ARG-001": "93.56", "ARG-002": "70.40", "ARG-003": "47.85", "BRA-001": "734.40", "BRA-002": "555.00",
    }
    assert out["BRA-002"]["nombre"] is None


def test_cleanup_flags_missing_emails_as_one(spark, rows):
    df = spark.createDataFrame(
        [(1, "a@x", "ok"), (2, "a@x", "ok"), (3, None, "ok"), (4, None, "ok"), (5, "b@x", "suspendido")],
        "id int, email string, estado string",
    )
    out = analytics.customer_cleanup(df, "id", "email", "estado")
    assert rows(out, "id", "email", "email_duplicado") == [
        (1, "a@x", False), (2, "a@x", True),
        (3, analytics.PLACEHOLDER_EMAIL, False), (4, analytics.PLACEHOLDER_EMAIL, True),
    ]


def test_period_over_period(orders):
    row = analytics.period_over_period(orders, "order_date", "total", "customer", "2024-02-01", 31).first()
    assert (row["pedidos_actual"], row["pedidos_anterior"]) == (3, 3)
    assert float(row["revenue_actual"]) == 475.0 and float(row["revenue_anterior"]) == 425.5
    assert (row["clientes_actual"], row["clientes_anterior"]) == (3, 2)
    assert row["variacion_clientes_pct"] == 50.0


def test_status_alert_uses_seven_days(spark):
    day = dt.date(2024, 1, 1)
    data = [(day + dt.timedelta(days=i), "a", "cancelled" if i == 0 else "ok") for i in (0, 1, 2, 6, 7, 8)]
    df = spark.createDataFrame(data, "d date, c string, s string")
    out = analytics.status_mix(df, "d", "c", "s", "cancelled").orderBy("fecha").collect()
    assert [r["pct_ventana"] for r in out] == [100.0, 50.0, 33.33, 25.0, 0.0, 0.0]
    assert [r["alerta"] for r in out] == [True, True, True, True, False, False]


def test_untapped(spark, rows):
    df = spark.createDataFrame([("a", 900, None), ("b", 900, 5), ("c", 10, None), ("d", 900, 7)], "ciudad string, population int, total_pedidos bigint")
    assert rows(analytics.untapped_markets(df, 100), "ciudad", "total_pedidos") == [("a", 0)]
