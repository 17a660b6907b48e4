"""The 17 staging models over raw documents derived from the tables.

The SQL side starts from the plain tables and never sees a JSON document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import staging
from quarry.workload.raw_docs import raw_tables
from quarry.workload.registry import query

BASE = """
WITH base AS (
    SELECT *, o_orderkey % 3 AS ch,
        CASE o_orderkey % 3 WHEN 0 THEN 'vtex' WHEN 1 THEN 'mercadolibre' ELSE 'garbarino' END AS canal,
        CASE n_nationkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'ARG' END AS country,
        lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS cp,
        CASE WHEN c_custkey % 11 <> 0 THEN 'c' || c_custkey || '@example.com' END AS email,
        'Calle ' || c_custkey AS street, CAST(c_custkey % 100 AS VARCHAR) AS door,
        CASE WHEN n_nationkey % 7 <> 6 THEN -55e0 + 1.3e0 * n_nationkey ELSE 0e0 END AS lat,
        CASE WHEN n_nationkey % 7 <> 6 THEN -70e0 + 0.7e0 * n_nationkey ELSE 0e0 END AS lon,
        o_orderkey % 50 <> 0 AS readable
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), senders AS (
    SELECT l_orderkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_orderkey
), sent AS (
    SELECT l_orderkey, suppkey, n_nationkey AS s_nation, n_name AS s_city, r_name AS s_state,
        lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS s_cp,
        CASE WHEN n_nationkey % 7 <> 6 THEN -55e0 + 1.3e0 * n_nationkey ELSE 0e0 END AS s_lat,
        CASE WHEN n_nationkey % 7 <> 6 THEN -70e0 + 0.7e0 * n_nationkey ELSE 0e0 END AS s_lon
    FROM senders JOIN supplier ON suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), lines AS (
    SELECT o_orderkey, canal,
        CASE ch WHEN 1 THEN 'P' ELSE '' END || l_partkey AS producto_id_origen,
        'Part ' || l_partkey AS nombre,
        CASE ch WHEN 1 THEN 'CAT' || (l_partkey % 10) END AS categoria_id,
        CAST(l_quantity AS INTEGER) AS cantidad,
        CASE ch WHEN 0 THEN floor(l_extendedprice * 100) / 100e0 ELSE l_extendedprice END AS precio,
        CASE ch WHEN 0 THEN l_quantity * floor(l_extendedprice * 100) / 100e0
            ELSE l_quantity * l_extendedprice END AS subtotal
    FROM lineitem JOIN base ON l_orderkey = o_orderkey
), buyers AS (
    SELECT DISTINCT canal, CAST(c_custkey AS VARCHAR) AS origin, email, c_name, c_mktsegment FROM base
), places AS (
    SELECT ciudad, provincia, pais, cp,
        md5(coalesce(ciudad, '') || '|' || coalesce(cp, '') || '|' || coalesce(pais, 'AR')) AS ubicacion_id,
        nullif(lat, 0) AS lat, nullif(lon, 0) AS lon
    FROM (
        SELECT n_name AS ciudad, r_name AS provincia, country AS pais, cp, lat, lon FROM base WHERE ch = 1
        UNION ALL SELECT s_city, s_state, 'AR', s_cp, s_lat, s_lon
            FROM base JOIN sent ON o_orderkey = l_orderkey WHERE ch = 1
        UNION ALL SELECT n_name, r_name, country, cp, NULL, NULL FROM base WHERE ch = 0 AND readable
        UNION ALL SELECT n_name, r_name, 'AR', '9999', lat, lon FROM base WHERE ch = 1 AND o_orderstatus = 'P'
    ) q
), addresses AS (
    SELECT *, md5(calle || '|' || altura || '|' || ciudad || '|' || cp || '|' || coalesce(pais, 'AR')) AS direccion_id
    FROM (
        SELECT 'Av ' || c_custkey AS calle, door AS altura, n_name AS ciudad, r_name AS provincia, cp,
            country AS pais, nullif(lat, 0) AS lat, nullif(lon, 0) AS lon, 'mercadolibre' AS fuente
        FROM base WHERE ch = 1
        UNION ALL SELECT street, door, n_name, r_name, cp, country, NULL, NULL, canal
        FROM base WHERE ch <> 1 AND readable
    ) q
), coords AS (
    SELECT md5('Calle ' || c_custkey || '|' || (c_custkey % 100) || '|' || n_name || '|'
            || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || '|'
            || coalesce(CASE n_nationkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'ARG' END, 'AR')) AS direccion_id,
        -55e0 + 1.3e0 * n_nationkey AS latitud, -70e0 + 0.7e0 * n_nationkey AS longitud,
        n_name AS matched_city, r_name AS matched_provincia,
        CASE WHEN n_nationkey % 10 <> 9 THEN CAST(1000 + 137 * n_nationkey AS INTEGER) END AS population,
        'exact' AS match_type
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), direcciones AS (
    SELECT direccion_id, any_value(calle) AS calle, any_value(altura) AS altura,
        CAST(NULL AS VARCHAR) AS complemento, any_value(ciudad) AS ciudad,
        any_value(provincia) AS provincia, any_value(cp) AS cp, any_value(pais) AS pais,
        min(lat) AS latitud, min(lon) AS longitud, min(fuente) AS fuente
    FROM addresses GROUP BY direccion_id
), geocodificadas AS (
    SELECT d.direccion_id, calle, altura, complemento, ciudad, provincia, cp, pais,
        coalesce(d.latitud, c.latitud) AS latitud, coalesce(d.longitud, c.longitud) AS longitud,
        fuente, matched_city, matched_provincia, population, match_type
    FROM direcciones d LEFT JOIN coords c ON c.direccion_id = d.direccion_id
)
"""


ORDERS = ("vtex_pedido", "meli_pedido", "garbarino_pedido")


def exact_money(df: DataFrame, *columns: str) -> DataFrame:
    """Amounts as decimals, so that sums are the same whatever the order of the rows."""
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in columns})


@query(
    "stg_canal",
    BASE
    + """
SELECT CAST(ch + 1 AS INTEGER) AS canal_id, canal,
    CASE ch WHEN 0 THEN 'vtex_pedido' WHEN 1 THEN 'meli_pedido' ELSE 'garbarino_pedido' END AS tabla_fuente,
    count(*) AS pedidos
FROM base GROUP BY ALL""",
)
def stg_canal(spark: SparkSession, sf: str) -> DataFrame:
    """The channel dimension, with the orders of each channel."""
    orders = staging.pedido(raw_tables(spark, sf, *ORDERS, "type_6"))
    counts = orders.groupBy("canal_id").agg(F.count(F.lit(1)).alias("pedidos"))
    return staging.canal(spark).join(counts, "canal_id")


@query(
    "stg_cliente",
    BASE
    + """
SELECT md5(canal || '|' || origin) AS cliente_id, canal, origin AS cliente_id_origen, email,
    c_name AS nombre, CASE canal WHEN 'vtex' THEN c_mktsegment END AS apellido,
    CAST(NULL AS VARCHAR) AS telefono
FROM buyers""",
)
def stg_cliente(spark: SparkSession, sf: str) -> DataFrame:
    return staging.cliente(raw_tables(spark, sf, *ORDERS))


@query(
    "stg_cliente_pedido",
    BASE
    + """
SELECT md5(canal || '|' || c_custkey) AS cliente_id, md5(canal || '|' || o_orderkey) AS pedido_id, canal,
    CASE ch WHEN 0 THEN floor(o_totalprice * 100) / 100e0 ELSE o_totalprice END AS monto_total,
    o_orderdate AS fecha_pedido, o_orderstatus AS status
FROM base""",
)
def stg_cliente_pedido(spark: SparkSession, sf: str) -> DataFrame:
    return staging.cliente_pedido(raw_tables(spark, sf, *ORDERS))


@query(
    "stg_cliente_canal",
    BASE
    + """
SELECT md5(canal || '|' || c_custkey) AS cliente_id, CAST(ch + 1 AS INTEGER) AS canal_id, canal,
    min(o_orderdate) AS primer_pedido, max(o_orderdate) AS ultimo_pedido, count(*) AS total_pedidos,
    CAST(sum(CAST(CASE ch WHEN 0 THEN floor(o_totalprice * 100) / 100e0 ELSE o_totalprice END
        AS DECIMAL(18, 2))) AS DOUBLE) AS monto_total_acumulado
FROM base GROUP BY c_custkey, ch, canal""",
)
def stg_cliente_canal(spark: SparkSession, sf: str) -> DataFrame:
    orders = exact_money(staging.cliente_pedido(raw_tables(spark, sf, *ORDERS)), "monto_total")
    activity = staging.cliente_canal(orders, staging.canal(spark))
    return activity.withColumn("monto_total_acumulado", F.col("monto_total_acumulado").cast("double"))


@query(
    "stg_cliente_ubicacion_geo",
    BASE
    + """
SELECT md5(canal || '|' || c_custkey) AS cliente_id,
    CASE WHEN ch = 1 OR readable THEN md5(n_name || '|' || cp || '|' || coalesce(country, 'AR'))
        ELSE md5('||AR') END AS ubicacion_id,
    'destino' AS tipo, max(o_orderdate) AS fecha_ultimo_pedido
FROM base WHERE ch IN (0, 1) GROUP BY 1, 2""",
)
def stg_cliente_ubicacion_geo(spark: SparkSession, sf: str) -> DataFrame:
    return staging.cliente_ubicacion_geo(raw_tables(spark, sf, *ORDERS, "type_6"))


@query(
    "stg_pedido",
    BASE
    + """
SELECT md5(canal || '|' || o_orderkey) AS pedido_id, CAST(o_orderkey AS VARCHAR) AS orden_id_origen,
    CAST(ch + 1 AS INTEGER) AS canal_id, canal, o_orderstatus AS status,
    CASE ch WHEN 0 THEN floor(o_totalprice * 100) / 100e0 ELSE o_totalprice END AS monto_total,
    o_orderdate AS fecha_creacion,
    CASE WHEN ch <> 2 THEN o_orderdate + INTERVAL 2 DAY END AS fecha_actualizacion,
    CASE WHEN ch = 1 AND o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY END AS fecha_cierre,
    CASE WHEN ch = 1 OR readable THEN
        md5(CASE ch WHEN 1 THEN 'Av ' || c_custkey ELSE street END || '|' || door || '|' || n_name || '|'
            || cp || '|' || coalesce(country, 'AR')) END AS direccion_id
FROM base""",
)
def stg_pedido(spark: SparkSession, sf: str) -> DataFrame:
    return staging.pedido(raw_tables(spark, sf, *ORDERS, "type_6"))


ITEMS = """
SELECT md5(md5(canal || '|' || o_orderkey) || '|' || producto_id_origen) AS item_pedido_id,
    md5(canal || '|' || o_orderkey) AS pedido_id, CAST(o_orderkey AS VARCHAR) AS orden_id_origen, canal,
    producto_id_origen, nombre AS nombre_producto, cantidad, precio AS precio_unitario, subtotal,
    'ARS' AS moneda
FROM lines"""


@query("stg_item_pedido", BASE + ITEMS)
def stg_item_pedido(spark: SparkSession, sf: str) -> DataFrame:
    return staging.item_pedido(raw_tables(spark, sf, *ORDERS))


@query(
    "stg_producto",
    BASE
    + """
SELECT md5(canal || '|' || producto_id_origen) AS producto_id, canal, producto_id_origen,
    any_value(nombre) AS nombre, any_value(categoria_id) AS categoria_id, min(precio) AS precio_unitario,
    'ARS' AS moneda
FROM lines GROUP BY canal, producto_id_origen""",
)
def stg_producto(spark: SparkSession, sf: str) -> DataFrame:
    return staging.producto(raw_tables(spark, sf, *ORDERS))


@query(
    "stg_canal_producto",
    BASE
    + """
SELECT CASE canal WHEN 'vtex' THEN 1 WHEN 'mercadolibre' THEN 2 ELSE 3 END AS canal_id, canal,
    md5(canal || '|' || producto_id_origen) AS producto_id, producto_id_origen,
    any_value(nombre) AS nombre, any_value(categoria_id) AS categoria_id,
    count(DISTINCT o_orderkey) AS total_pedidos, CAST(sum(cantidad) AS BIGINT) AS total_unidades,
    CAST(sum(CAST(subtotal AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_total,
    CAST(min(precio) AS DOUBLE) AS precio_min, CAST(max(precio) AS DOUBLE) AS precio_max,
    CAST(sum(CAST(precio AS DECIMAL(18, 2))) AS DOUBLE) / count(precio) AS precio_promedio
FROM lines GROUP BY canal, producto_id_origen""",
)
def stg_canal_producto(spark: SparkSession, sf: str) -> DataFrame:
    documents = raw_tables(spark, sf, *ORDERS)
    items = exact_money(staging.item_pedido(documents), "precio_unitario", "subtotal")
    sold = staging.canal_producto(staging.producto(documents), staging.canal(spark), items)
    return sold.withColumns({c: F.col(c).cast("double") for c in ("revenue_total", "precio_min", "precio_max")})


@query("stg_direccion", BASE + "SELECT * FROM direcciones")
def stg_direccion(spark: SparkSession, sf: str) -> DataFrame:
    return staging.direccion(raw_tables(spark, sf, *ORDERS, "type_6"))


@query("stg_geo_coords", BASE + "SELECT * FROM coords")
def stg_geo_coords(spark: SparkSession, sf: str) -> DataFrame:
    return staging.geo_coords(raw_tables(spark, sf, "geo_coords"))


@query("stg_direccion_geocodificada", BASE + "SELECT * FROM geocodificadas")
def stg_direccion_geocodificada(spark: SparkSession, sf: str) -> DataFrame:
    documents = raw_tables(spark, sf, *ORDERS, "type_6", "geo_coords")
    return staging.direccion_geocodificada(staging.direccion(documents), staging.geo_coords(documents))


@query(
    "stg_ubicacion_geo",
    BASE
    + """
, means AS (
    SELECT lower(ciudad) AS city, avg(latitud) AS lat, avg(longitud) AS lon FROM geocodificadas GROUP BY 1
), chosen AS (
    SELECT ubicacion_id, any_value(ciudad) AS ciudad, any_value(provincia) AS provincia,
        -- the same place key may carry AR or no country; rows with coordinates first, then AR
        arg_min(coalesce(pais, 'none'), CASE WHEN lat IS NULL THEN 1 ELSE 0 END * 2 + CASE WHEN pais IS NULL THEN 1 ELSE 0 END) AS pais,
        any_value(cp) AS cp, min(lat) AS lat, min(lon) AS lon
    FROM places GROUP BY ubicacion_id
)
SELECT ubicacion_id, ciudad, provincia,
    CASE pais WHEN 'ARG' THEN 'AR' WHEN 'none' THEN NULL ELSE pais END AS pais_codigo, cp AS codigo_postal,
    round(coalesce(chosen.lat, means.lat), 6) AS latitud, round(coalesce(chosen.lon, means.lon), 6) AS longitud
FROM chosen LEFT JOIN means ON lower(ciudad) = city""",
)
def stg_ubicacion_geo(spark: SparkSession, sf: str) -> DataFrame:
    documents = raw_tables(spark, sf, *ORDERS, "type_6", "geo_coords", "meli_pickup")
    geocoded = staging.direccion_geocodificada(staging.direccion(documents), staging.geo_coords(documents))
    places = staging.ubicacion_geo(documents, geocoded)
    return places.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


@query(
    "stg_envio_detalle",
    BASE
    + """
SELECT CAST(o_orderkey AS VARCHAR) AS envio_id, CAST(o_orderkey AS VARCHAR) AS orden_id_origen,
    o_orderstatus AS status, CAST(NULL AS VARCHAR) AS substatus, o_orderpriority AS logistic_type,
    'T' || o_orderkey AS tracking_number, 'correo' AS tracking_method, o_orderdate AS fecha_creacion,
    o_orderdate + INTERVAL 2 DAY AS fecha_actualizacion,
    s_city AS origen_ciudad, s_state AS origen_provincia, CASE WHEN s_city IS NOT NULL THEN 'AR' END AS origen_pais,
    s_cp AS origen_codigo_postal, s_lat AS origen_latitud, s_lon AS origen_longitud,
    CASE WHEN s_city IS NOT NULL THEN 'Deposito' END AS origen_calle, CAST(suppkey AS VARCHAR) AS origen_numero,
    n_name AS destino_ciudad, r_name AS destino_provincia, country AS destino_pais, cp AS destino_codigo_postal,
    lat AS destino_latitud, lon AS destino_longitud, 'Av ' || c_custkey AS destino_calle, door AS destino_numero,
    CAST(NULL AS VARCHAR) AS destino_complemento
FROM base LEFT JOIN sent ON o_orderkey = l_orderkey WHERE ch = 1""",
)
def stg_envio_detalle(spark: SparkSession, sf: str) -> DataFrame:
    return staging.envio_detalle(raw_tables(spark, sf, "type_6"))


POINTS = """
SELECT md5('origen|mercadolibre|' || o_orderkey) AS geo_envio_id, 'origen_vendedor' AS tipo,
    'mercadolibre' AS canal, CAST(o_orderkey AS VARCHAR) AS orden_id_origen, s_city AS ciudad,
    s_state AS provincia, 'AR' AS pais_codigo, s_cp AS codigo_postal, s_lat AS latitud, s_lon AS longitud,
    'Deposito' AS calle, CAST(suppkey AS VARCHAR) AS numero
FROM base JOIN sent ON o_orderkey = l_orderkey WHERE ch = 1
UNION ALL
SELECT md5('destino|mercadolibre|' || o_orderkey), 'destino_comprador', 'mercadolibre',
    CAST(o_orderkey AS VARCHAR), n_name, r_name, country, cp, lat, lon, 'Av ' || c_custkey, door
FROM base WHERE ch = 1
UNION ALL
SELECT md5('destino|vtex|' || o_orderkey), 'destino_comprador', 'vtex', CAST(o_orderkey AS VARCHAR),
    CASE WHEN readable THEN n_name END, CASE WHEN readable THEN r_name END,
    CASE WHEN readable THEN country END, CASE WHEN readable THEN cp END, NULL, NULL,
    CASE WHEN readable THEN street END, CASE WHEN readable THEN door END
FROM base WHERE ch = 0
UNION ALL
SELECT md5('retiro|mercadolibre|' || o_orderkey), 'retiro_sucursal', 'mercadolibre',
    CAST(o_orderkey AS VARCHAR), n_name, r_name, NULL, '9999', lat, lon, 'Local 1', NULL
FROM base WHERE ch = 1 AND o_orderstatus = 'P'"""


@query("stg_geo_envio", BASE + POINTS)
def stg_geo_envio(spark: SparkSession, sf: str) -> DataFrame:
    return staging.geo_envio(raw_tables(spark, sf, "vtex_pedido", "type_6", "meli_pickup"))


@query(
    "stg_meli_pago_detalle",
    BASE
    + """
SELECT CAST(o_orderkey AS VARCHAR) AS pago_id, CAST(o_orderkey AS VARCHAR) AS orden_id_origen,
    'approved' AS status, 'accredited' AS status_detail, o_orderdate AS fecha_creacion,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS fecha_aprobacion,
    o_totalprice AS monto_transaccion, o_totalprice AS monto_pagado_total,
    o_totalprice * 0.88e0 AS monto_neto_recibido, o_totalprice * 0.1e0 AS comision_mercadopago,
    CAST(NULL AS DOUBLE) AS comision_marketplace, 'credit_card' AS tipo_pago,
    o_orderpriority AS metodo_pago_id, CAST(o_orderkey % 12 + 1 AS INTEGER) AS cuotas, 'ARS' AS moneda,
    CAST(c_custkey AS VARCHAR) AS pagador_id, email AS pagador_email, c_name AS pagador_nombre
FROM base WHERE ch = 1""",
)
def stg_meli_pago_detalle(spark: SparkSession, sf: str) -> DataFrame:
    return staging.meli_pago_detalle(raw_tables(spark, sf, "type_8"))


@query(
    "stg_meli_pickup_detalle",
    BASE
    + """
SELECT 'PK' || o_orderkey AS pickup_id, CAST(o_orderkey AS VARCHAR) AS orden_id_origen, 'ready' AS status,
    o_orderdate AS fecha_creacion, o_orderdate + INTERVAL 3 DAY AS fecha_lista,
    CAST(c_custkey AS VARCHAR) AS comprador_id, CAST(n_nationkey AS VARCHAR) AS tienda_id,
    'Tienda ' || n_name AS tienda_nombre, n_name AS tienda_ciudad, r_name AS tienda_provincia,
    '9999' AS tienda_codigo_postal, 'Local 1' AS tienda_direccion, lat AS tienda_latitud,
    lon AS tienda_longitud, c_name AS persona_nombre, 'DNI' AS persona_doc_tipo,
    CAST(c_custkey AS VARCHAR) AS persona_doc_numero
FROM base WHERE ch = 1 AND o_orderstatus = 'P'""",
)
def stg_meli_pickup_detalle(spark: SparkSession, sf: str) -> DataFrame:
    return staging.meli_pickup_detalle(raw_tables(spark, sf, "meli_pickup"))
