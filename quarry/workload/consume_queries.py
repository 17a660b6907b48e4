"""The 10 consume models and the pieces they are made of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import consume
from quarry.workload.bindings import AS_OF, Bound, as_double
from quarry.workload.registry import query
from quarry.workload.sql import CATALOGUE, MARKET, SALES, half_up


def rounded_point(df: DataFrame) -> DataFrame:
    """Mean coordinates without the last digits, which depend on the order of the sum."""
    return df.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


POINT = f"{half_up('latitud', 6)} AS latitud, {half_up('longitud', 6)} AS longitud"


@query(
    "daily_sales",
    SALES
    + """
SELECT date_trunc('day', o_orderdate) AS fecha, o_orderpriority AS canal, plain AS provincia,
    count(*) AS pedidos, count(DISTINCT o_custkey) AS clientes_unicos,
    CAST(sum(amount) AS DOUBLE) AS revenue, CAST(sum(amount) AS DOUBLE) / count(*) AS ticket_promedio
FROM located WHERE o_totalprice > 0 AND o_orderdate IS NOT NULL
GROUP BY ALL""",
)
def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return as_double(
        consume.ventas_diarias(
            b.pedido, b.item_pedido, b.cliente_pedido, b.cliente_ubicacion_geo, b.ubicacion_geo
        )
    )


@query(
    "sales_by_channel",
    SALES
    + """
SELECT o_orderpriority AS canal, plain AS provincia, count(*) AS total_pedidos,
    count(DISTINCT o_custkey) AS clientes_unicos, CAST(sum(amount) AS DOUBLE) AS revenue_total,
    CAST(sum(amount) AS DOUBLE) / count(*) AS ticket_promedio, CAST(sum(units) AS BIGINT) AS total_unidades,
    min(o_orderdate) AS primer_pedido, max(o_orderdate) AS ultimo_pedido
FROM located WHERE o_totalprice > 0
GROUP BY o_orderpriority, plain""",
)
def sales_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return as_double(
        consume.ventas_por_canal(
            b.pedido, b.item_pedido, b.cliente_pedido, b.cliente_ubicacion_geo, b.ubicacion_geo
        )
    )


@query(
    "top_products",
    CATALOGUE
    + """
SELECT * EXCLUDE (canal_id), rank() OVER (PARTITION BY canal ORDER BY revenue_total DESC) AS rank_revenue,
    rank() OVER (PARTITION BY canal ORDER BY total_unidades DESC) AS rank_unidades
FROM catalogue""",
)
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(consume.top_productos(Bound(spark, sf).canal_producto))


@query(
    "customer_summary",
    SALES
    + f"""
, used AS (
    SELECT o_custkey, o_orderpriority AS canal, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS amt
    FROM orders GROUP BY ALL
), preferred AS (
    SELECT o_custkey AS pk, arg_min(canal, place) AS canal, count(*) AS canales FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, amt DESC, canal) AS place FROM used
    ) q GROUP BY o_custkey
)
SELECT c_custkey AS cliente_id, lower(c_name) || '@example.com' AS email, c_name AS nombre,
    CAST(NULL AS VARCHAR) AS apellido, c_mktsegment AS canal_origen, count(*) AS total_pedidos,
    CAST(sum(amount) AS DOUBLE) AS ltv, CAST(sum(amount) AS DOUBLE) / count(*) AS ticket_promedio,
    min(o_orderdate) AS primer_pedido, max(o_orderdate) AS ultimo_pedido, any_value(canales) AS canales_usados,
    CASE WHEN max(o_orderdate) >= DATE '{AS_OF}' - INTERVAL 12 MONTH THEN 'Activo' ELSE 'Inactivo' END AS estado_cliente,
    any_value(p.canal) AS canal_preferido
FROM customer JOIN sold ON o_custkey = c_custkey JOIN preferred p ON pk = c_custkey
GROUP BY c_custkey, c_name, c_mktsegment""",
)
def customer_summary(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return as_double(
        consume.clientes_resumen(
            b.cliente, b.cliente_pedido, b.item_pedido, b.cliente_canal, dt.date.fromisoformat(AS_OF)
        )
    )


@query(
    "catalog_coverage",
    CATALOGUE
    + f"""
, per_channel AS (SELECT canal, count(*) AS in_channel FROM catalogue GROUP BY canal),
whole AS (SELECT count(DISTINCT producto_id_origen) AS everything FROM catalogue)
SELECT c.canal, nombre AS nombre_producto, categoria_id, producto_id_origen, total_pedidos, total_unidades,
    revenue_total, precio_min, precio_max, precio_promedio,
    count(*) OVER (PARTITION BY producto_id_origen) AS canales_con_presencia,
    count(*) OVER (PARTITION BY producto_id_origen) = 1 AS exclusivo_canal,
    {half_up("in_channel * 100e0 / everything", 2)} AS cobertura_canal_pct
FROM catalogue c JOIN per_channel p ON p.canal = c.canal, whole""",
)
def catalog_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(consume.cobertura_catalogo(Bound(spark, sf).canal_producto))


@query(
    "sales_by_location",
    SALES
    + f"""
SELECT ciudad, provincia, pais, {POINT},
    CAST(CAST(latitud AS DECIMAL(12, 4)) AS VARCHAR) || ',' || CAST(CAST(longitud AS DECIMAL(12, 4)) AS VARCHAR) AS geo_point,
    population, clientes_unicos, total_pedidos, revenue_total, ticket_promedio
FROM by_city""",
)
def sales_by_location(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_point(as_double(Bound(spark, sf).sales_by_location(4)))


@query("market_penetration", MARKET + f"SELECT * EXCLUDE (latitud, longitud), {POINT} FROM market")
def market_penetration(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_point(as_double(Bound(spark, sf).market()))


CHANGE = "(tasa_penetracion - tasa_penetracion_mes_anterior)"
TREND = (
    SALES
    + f"""
, monthly AS (
    SELECT ciudad, accented AS provincia, 'AR' AS pais_codigo, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
        any_value(population) AS population, count(*) AS total_pedidos, count(DISTINCT o_custkey) AS clientes_unicos,
        CAST(sum(amount) AS DOUBLE) AS revenue_total
    FROM located WHERE ciudad IS NOT NULL GROUP BY ALL
), rates AS (
    SELECT *, CAST(year(mes) AS INTEGER) AS anio, CAST(month(mes) AS INTEGER) AS mes_num,
        {half_up("CAST(total_pedidos AS DOUBLE) / population", 6)} AS tasa_penetracion,
        avg(total_pedidos) OVER (PARTITION BY ciudad, year(mes)) AS year_mean
    FROM monthly
), series AS (
    SELECT *, lag(tasa_penetracion) OVER (PARTITION BY ciudad ORDER BY mes) AS tasa_penetracion_mes_anterior
    FROM rates
)
"""
)


@query(
    "penetration_trend",
    TREND
    + f"""
SELECT * EXCLUDE (year_mean), {half_up(CHANGE, 6)} AS variacion_abs,
    CASE WHEN tasa_penetracion_mes_anterior > 0
        THEN {half_up(CHANGE + " / tasa_penetracion_mes_anterior * 100", 2)} END AS variacion_pct,
    coalesce(tasa_penetracion_mes_anterior > 0
        AND {CHANGE} / tasa_penetracion_mes_anterior <= -0.20e0, FALSE) AS alerta_caida,
    {half_up("total_pedidos / year_mean", 2)} AS indice_estacionalidad
FROM series""",
)
def penetration_trend(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return as_double(
        consume.penetracion_evolucion(
            b.cliente_pedido, b.item_pedido, b.published_bridge, b.ubicacion_geo, b.published_locations
        )
    )


DOMINANCE = (
    SALES
    + """
, by_channel AS (
    SELECT ciudad, accented AS provincia, 'AR' AS pais_codigo, o_orderpriority AS canal,
        count(*) AS total_pedidos, count(DISTINCT o_custkey) AS clientes_unicos, sum(amount) AS exact_revenue,
        CAST(sum(amount) AS DOUBLE) AS revenue_total
    FROM located WHERE o_totalprice > 0 AND ciudad IS NOT NULL GROUP BY ALL
), totals AS (
    SELECT ciudad, CAST(sum(total_pedidos) AS BIGINT) AS total_pedidos_ciudad,
        CAST(sum(exact_revenue) AS DOUBLE) AS total_revenue_ciudad
    FROM by_channel GROUP BY ciudad
)
"""
)


@query(
    "channel_dominance",
    DOMINANCE
    + f"""
SELECT b.* EXCLUDE (exact_revenue), total_pedidos_ciudad, total_revenue_ciudad,
    {half_up("total_pedidos * 100e0 / total_pedidos_ciudad", 2)} AS share_pedidos_pct,
    {half_up("revenue_total * 100e0 / total_revenue_ciudad", 2)} AS share_revenue_pct,
    rank() OVER (PARTITION BY b.ciudad ORDER BY total_pedidos DESC) = 1 AS canal_dominante
FROM by_channel b JOIN totals t ON t.ciudad = b.ciudad""",
)
def channel_dominance(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return as_double(
        consume.dominancia_canal_geo(
            b.cliente_pedido, b.pedido, b.item_pedido, b.cliente_ubicacion_geo, b.ubicacion_geo
        )
    )


HAVERSINE = """2 * 6371 * asin(sqrt(power(sin(radians({lat} - -34.6037e0) / 2), 2)
    + cos(radians(-34.6037e0)) * cos(radians({lat})) * power(sin(radians({lon} - -58.3816e0) / 2), 2)))"""

RETENTION = (
    MARKET
    + f"""
, per_customer AS (
    SELECT o_custkey, ciudad, accented, any_value(lat) AS lat, any_value(lon) AS lon, count(*) AS n
    FROM located WHERE ciudad IS NOT NULL GROUP BY ALL
), kept AS (
    SELECT ciudad, accented AS provincia, 'AR' AS pais_codigo, any_value(lat) AS latitud, any_value(lon) AS longitud,
        count(*) AS total_clientes, count(*) FILTER (n >= 2) AS clientes_recurrentes
    FROM per_customer WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY ciudad, accented
), measured AS (
    SELECT k.*, m.population, m.total_pedidos, m.revenue_total, m.tasa_penetracion,
        {half_up("clientes_recurrentes * 100e0 / total_clientes", 2)} AS tasa_retencion_pct,
        {half_up(HAVERSINE.format(lat="k.latitud", lon="k.longitud"), 1)} AS distancia_cd_km
    FROM kept k LEFT JOIN market m ON m.ciudad = k.ciudad
)
"""
)


@query(
    "geo_retention",
    RETENTION
    + f"""
SELECT * EXCLUDE (latitud, longitud), {POINT},
    {half_up("(SELECT corr(distancia_cd_km, tasa_penetracion) FROM measured)", 4)} AS correlacion_distancia_penetracion
FROM measured""",
)
def geo_retention(spark: SparkSession, sf: str) -> DataFrame:
    b = Bound(spark, sf)
    return rounded_point(
        as_double(
            consume.retencion_geografica(
                b.cliente_pedido, b.item_pedido, b.published_bridge, b.ubicacion_geo, b.market()
            )
        )
    )
