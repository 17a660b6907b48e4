"""Consume models on small hand-made tables, and on data with one dominating customer."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.keys import packed, unpacked
from quarry.plans import consume


@pytest.fixture(scope="module")
def shop(spark):
    """30 % of the orders have no customer, 30 % belong to one customer, 10 % have no items."""
    rng = np.random.default_rng(11)
    n = 3000
    kind = rng.random(n)
    customers = np.where(kind < 0.3, -1, np.where(kind < 0.6, 0, rng.integers(1, 200, n)))
    orders = [
        (
            i, None if customers[i] < 0 else int(customers[i]), ["a", "b", "c"][int(rng.integers(3))],
            float(rng.integers(0, 1000)), dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 9000))),
        )
        for i in range(n)
    ]
    base = spark.createDataFrame(
        orders, "pedido_id int, cliente_id int, canal string, monto_total double, fecha timestamp_ntz"
    ).withColumn("monto_total", F.col("monto_total").cast("decimal(18,2)"))
    items = spark.createDataFrame(
        [(i, int(q)) for i in range(n) if i % 10 for q in rng.integers(1, 5, 2)], "pedido_id int, cantidad int"
    )
    bridge = spark.createDataFrame(
        [(c, int(u), dt.datetime(2024, 1, 1 + int(u))) for c in range(150) for u in rng.integers(0, 6, 2)],
        "cliente_id int, ubicacion_id int, fecha_ultimo_pedido timestamp_ntz",
    )
    places = spark.createDataFrame(
        [(u, ["Córdoba", "Rosario", None][u % 3], ["Córdoba", "SANTA FE", "X"][u % 3], "AR", -30.0 - u, None if u == 4 else -60.0)
         for u in range(6)],
        "ubicacion_id int, ciudad string, provincia string, pais_codigo string, latitud double, longitud double",
    )
    population = spark.createDataFrame([("cordoba", 1000), ("ROSARIO", 500), ("x", None)], "ciudad string, population int")
    tables = {
        "pedido": base.withColumnRenamed("fecha", "fecha_creacion").drop("cliente_id"),
        "cliente_pedido": base.withColumnRenamed("fecha", "fecha_pedido"),
        "item_pedido": items, "bridge": bridge, "places": places, "population": population,
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(f"t_{name}")
    return tables


PRINCIPAL = """principal AS (
    SELECT cliente_id, ubicacion_id FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id
        ORDER BY fecha_ultimo_pedido DESC NULLS LAST, ubicacion_id) AS rn FROM t_bridge) WHERE rn = 1)"""
FOLD = "upper(translate(provincia, 'ÁÉÍÓÚáéíóú', 'AEIOUaeiou'))"


def test_daily_sales_equals_the_row_level_join(spark, shop, rows):
    expected = spark.sql(f"""WITH {PRINCIPAL}, base AS (
        SELECT CAST(date_trunc('day', p.fecha_creacion) AS TIMESTAMP_NTZ) AS fecha, p.canal, {FOLD} AS provincia, p.pedido_id, p.monto_total, cp.cliente_id
        FROM t_pedido p LEFT JOIN t_cliente_pedido cp ON cp.pedido_id = p.pedido_id
        LEFT JOIN principal up ON up.cliente_id = cp.cliente_id LEFT JOIN t_places ug ON ug.ubicacion_id = up.ubicacion_id
        WHERE p.monto_total > 0 AND EXISTS (SELECT 1 FROM t_item_pedido i WHERE i.pedido_id = p.pedido_id))
        SELECT fecha, canal, provincia, count(DISTINCT pedido_id), count(DISTINCT cliente_id), sum(monto_total) FROM base GROUP BY 1, 2, 3""")
    got = consume.ventas_diarias(shop["pedido"], shop["item_pedido"], shop["cliente_pedido"], shop["bridge"], shop["places"])
    assert rows(got, "fecha", "canal", "provincia", "pedidos", "clientes_unicos", "revenue") == rows(expected)


def test_sales_by_channel_has_units_without_province(spark, shop, rows):
    expected = spark.sql(f"""WITH {PRINCIPAL}, base AS (
        SELECT p.canal, {FOLD} AS provincia, p.pedido_id, p.monto_total, cp.cliente_id
        FROM t_pedido p LEFT JOIN t_cliente_pedido cp ON cp.pedido_id = p.pedido_id
        LEFT JOIN principal up ON up.cliente_id = cp.cliente_id LEFT JOIN t_places ug ON ug.ubicacion_id = up.ubicacion_id
        WHERE p.monto_total > 0 AND EXISTS (SELECT 1 FROM t_item_pedido i WHERE i.pedido_id = p.pedido_id)),
        k AS (SELECT canal, provincia, count(DISTINCT pedido_id) n, count(DISTINCT cliente_id) c, sum(monto_total) s FROM base GROUP BY 1, 2),
        u AS (SELECT canal, provincia, sum(cantidad) u FROM base JOIN t_item_pedido i ON i.pedido_id = base.pedido_id GROUP BY 1, 2)
        SELECT k.canal, k.provincia, n, c, s, u FROM k JOIN u ON u.canal = k.canal AND u.provincia <=> k.provincia""")
    got = consume.ventas_por_canal(shop["pedido"], shop["item_pedido"], shop["cliente_pedido"], shop["bridge"], shop["places"])
    columns = ["canal", "provincia", "total_pedidos", "clientes_unicos", "revenue_total", "total_unidades"]
    assert rows(got, *columns) == rows(expected)


def located(shop):
    return consume.ventas_por_ubicacion(
        shop["bridge"], shop["places"], shop["cliente_pedido"], shop["item_pedido"], shop["population"]
    )


def test_sales_by_location_equals_the_row_level_join(spark, shop):
    expected = spark.sql(f"""WITH {PRINCIPAL}, base AS (
        SELECT translate(ug.ciudad, 'ó', 'o') AS ciudad, {FOLD} AS provincia, ug.latitud, ug.longitud, up.cliente_id, cp.pedido_id, cp.monto_total
        FROM principal up JOIN t_places ug ON ug.ubicacion_id = up.ubicacion_id
        LEFT JOIN (SELECT * FROM t_cliente_pedido c WHERE EXISTS (SELECT 1 FROM t_item_pedido i WHERE i.pedido_id = c.pedido_id)) cp
            ON cp.cliente_id = up.cliente_id WHERE ug.ciudad IS NOT NULL)
        SELECT ciudad, avg(latitud) lat, avg(longitud) lon, count(DISTINCT cliente_id) c, count(DISTINCT pedido_id) n, sum(monto_total) s
        FROM base GROUP BY ciudad, provincia""").collect()
    got = {r["ciudad"]: r for r in located(shop).collect()}
    assert len(got) == len(expected) == 2
    for e in expected:
        g = got[e["ciudad"]]
        assert g["latitud"] == pytest.approx(e["lat"]) and g["longitud"] == pytest.approx(e["lon"])
        assert (g["clientes_unicos"], g["total_pedidos"], g["revenue_total"]) == (e["c"], e["n"], e["s"])
        assert g["pais"] == "Argentina" and g["population"] in (1000, 500)


def test_location_tables_join_on_folded_names(shop):
    by_place = located(shop)
    market = consume.penetracion_mercado(by_place)
    assert market.count() == 2
    trend = consume.penetracion_evolucion(
        shop["cliente_pedido"], shop["item_pedido"], shop["bridge"], shop["places"], by_place
    )
    assert trend.where("population IS NULL").count() == 0
    first = trend.where("ciudad = 'Córdoba'").orderBy("mes").first()
    assert first["tasa_penetracion_mes_anterior"] is None and first["alerta_caida"] is False
    kept = consume.retencion_geografica(
        shop["cliente_pedido"], shop["item_pedido"], shop["bridge"], shop["places"], market
    ).collect()
    assert {r["ciudad"] for r in kept} == {"Córdoba", "Rosario"}
    assert all(r["tasa_penetracion"] is not None and r["clientes_recurrentes"] <= r["total_clientes"] for r in kept)


def test_dominance_shares_add_up(shop):
    out = consume.dominancia_canal_geo(
        shop["cliente_pedido"], shop["pedido"], shop["item_pedido"], shop["bridge"], shop["places"]
    )
    for city in out.groupBy("ciudad").agg(F.sum("share_pedidos_pct").alias("s"), F.count_if("canal_dominante").alias("d")).collect():
        assert city["s"] == pytest.approx(100, abs=0.05) and city["d"] >= 1


def test_quadrants(spark):
    cities = spark.createDataFrame(
        [("a", 1000, 100), ("b", 1000, 1), ("c", 10, 9), ("d", 10, 1), ("e", 0, 5)],
        "ciudad string, population int, total_pedidos bigint",
    )
    for name in ("provincia", "pais"):
        cities = cities.withColumn(name, F.lit("x"))
    full = cities.withColumns(
        {"latitud": F.lit(1.0), "longitud": F.lit(1.0), "clientes_unicos": F.lit(1), "ticket_promedio": F.lit(2.0),
         "revenue_total": F.col("total_pedidos") * 2.0}
    )
    out = {r["ciudad"]: r for r in consume.penetracion_mercado(full).collect()}
    assert set(out) == {"a", "b", "c", "d"}
    assert out["b"]["cuadrante_estrategico"] == "Gigante dormido"
    assert out["c"]["cuadrante_estrategico"] == "Nicho fiel"
    assert out["b"]["revenue_potencial_incremental"] > 0 == out["c"]["revenue_potencial_incremental"]


def test_usual_order(shop):
    out = consume.sorted_by(located(shop), "ventas_por_ubicacion").collect()
    assert [r["revenue_total"] for r in out] == sorted((r["revenue_total"] for r in out), reverse=True)


def test_tables_joined_before_give_the_same_models(spark, shop, rows):
    orders, sales, items = shop["pedido"], shop["cliente_pedido"], shop["item_pedido"]
    bridge, places, population = shop["bridge"], shop["places"], shop["population"]
    # a second row of one sale, a sale without an order, an order without a sale
    sales = sales.unionByName(sales.where("pedido_id = 21")).where("pedido_id != 33")
    orders = orders.where("pedido_id != 44")
    owned = consume.owned_orders(orders, items, sales)
    valid = consume.valid_orders(sales, items)
    customers = consume.located_customers(bridge, places)
    by_place = consume.ventas_por_ubicacion(bridge, places, sales, items, population)
    market = consume.penetracion_mercado(by_place)
    for parts, joined in (
        (consume.ventas_diarias(orders, items, sales, bridge, places), consume.ventas_diarias(owned, None, None, customers, None)),
        (consume.ventas_por_canal(orders, items, sales, bridge, places), consume.ventas_por_canal(owned, None, None, customers, None)),
        (consume.dominancia_canal_geo(sales, orders, items, bridge, places), consume.dominancia_canal_geo(None, owned, None, customers, None)),
        (by_place, consume.ventas_por_ubicacion(customers, None, valid, None, population)),
        (consume.penetracion_evolucion(sales, items, bridge, places, by_place), consume.penetracion_evolucion(valid, None, customers, None, by_place)),
        (consume.retencion_geografica(sales, items, bridge, places, market), consume.retencion_geografica(valid, None, customers, None, market)),
    ):
        exact = [f"round({c}, 9) AS {c}" if t == "double" else c for c, t in parts.dtypes]
        assert rows(joined.selectExpr(*exact)) == rows(parts.selectExpr(*exact)) != []


def test_orders_of_customers_come_from_all_orders(spark, shop, rows):
    orders, sales, items = shop["pedido"], shop["cliente_pedido"], shop["item_pedido"]
    sales = sales.where("pedido_id != 33")  # an order of nobody
    nameless = F.when(F.col("pedido_id") != 21, F.md5(F.col("cliente_id").cast("string"))).alias("cliente_id")
    sales = sales.select(nameless, *[c for c in sales.columns if c != "cliente_id"])
    valid = consume.valid_orders(sales, items).select("cliente_id", "monto_total", "fecha_pedido")
    owned = consume.owned_orders(orders, items, packed(sales, "cliente_id"), "fecha_pedido")
    assert rows(unpacked(consume.bought_orders(owned), "cliente_id")) == rows(valid) != []
    assert owned.schema["cliente_id"].dataType.typeName() == "binary"
    assert {r["cliente_id"] is None for r in valid.collect()} == {True, False}
