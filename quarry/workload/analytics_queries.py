"""Documented analyses on the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import analytics, staging
from quarry.plans.consume import principal_location, valid_orders
from quarry.session import materialise
from quarry.sources.inline import inline_relation
from quarry.workload.bindings import Bound, as_double, money
from quarry.workload.raw_docs import raw_tables
from quarry.workload.registry import query, table
from quarry.workload.sql import SALES, half_up
from quarry.workload.staging_queries import BASE


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("o_totalprice", money("o_totalprice"))


AMOUNT = "CAST(o_totalprice AS DECIMAL(18, 2))"
MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def cents_mean(condition: str = "TRUE") -> str:
    """Mean of the amounts in cents, rounded half up to whole cents by integer arithmetic."""
    cents = f"CAST(sum(CASE WHEN {condition} THEN {AMOUNT} * 100 END) AS BIGINT)"
    n = f"count(CASE WHEN {condition} THEN 1 END)"
    return f"(2 * {cents} + {n}) // (2 * {n}) / 100e0"


@query(
    "monthly_sales",
    f"""SELECT {MONTH} AS mes, count(*) AS total_pedidos, CAST(sum({AMOUNT}) AS DOUBLE) AS monto_total,
        CAST(sum({AMOUNT}) AS DOUBLE) / count(*) AS ticket_promedio, count(DISTINCT o_custkey) AS clientes_unicos
    FROM orders GROUP BY 1""",
)
def monthly_sales(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(analytics.monthly_sales(_orders(spark, sf), "o_orderdate", "o_totalprice", "o_custkey"))


@query(
    "customer_segments",
    f"""SELECT *, CASE WHEN total_spent >= 1500000 THEN 'VIP' WHEN total_spent >= 500000 THEN 'Regular' ELSE 'New' END AS segment
    FROM (SELECT o_custkey, count(*) AS total_orders,
            CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {AMOUNT} ELSE 0 END) AS DOUBLE) AS total_spent,
            {cents_mean("o_orderstatus = 'F'")} AS avg_order, max(o_orderdate) AS last_order
        FROM orders GROUP BY 1) q""",
)
def customer_segments(spark: SparkSession, sf: str) -> DataFrame:
    limits = [(1500000.0, "VIP"), (500000.0, "Regular")]
    return as_double(
        analytics.customer_segments(
            _orders(spark, sf), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "F", limits
        )
    )


@query(
    "monthly_completion",
    f"""SELECT {MONTH} AS month, count(*) AS orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS completed,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {AMOUNT} ELSE 0 END) AS DOUBLE) AS revenue,
        {half_up("count(CASE WHEN o_orderstatus = 'F' THEN 1 END) * 100e0 / count(*)", 1)} AS completion_rate_pct
    FROM orders GROUP BY 1""",
)
def monthly_completion(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(
        analytics.monthly_completion(_orders(spark, sf), "o_orderdate", "o_orderstatus", "o_totalprice", "F")
    )


@query(
    "product_summary",
    """SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total_cantidad,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
        count(DISTINCT o_custkey) AS clientes_unicos
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def product_summary(spark: SparkSession, sf: str) -> DataFrame:
    owners = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    return as_double(
        analytics.product_summary(
            lines, "l_partkey", F.col("l_quantity").cast("bigint"), money("l_extendedprice"), "o_custkey"
        )
    )


@query(
    "monthly_revenue_excl",
    f"""SELECT {MONTH} AS mes, count(DISTINCT o_orderkey) AS pedidos, CAST(sum({AMOUNT}) AS DOUBLE) AS revenue,
        {half_up(f"CAST(sum({AMOUNT}) AS DOUBLE) / count(*)", 0)} AS ticket_promedio,
        count(DISTINCT o_custkey) AS clientes_unicos
    FROM orders WHERE o_orderstatus NOT IN ('P') GROUP BY 1""",
)
def monthly_revenue_excl(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(
        analytics.monthly_revenue(
            _orders(spark, sf), "o_orderdate", "o_totalprice", "o_custkey", "o_orderstatus", ["P"]
        )
    )


@query(
    "top_customers",
    f"""SELECT c_custkey, c_name, c_mktsegment, count(*) AS compras, CAST(sum({AMOUNT}) AS DOUBLE) AS total_gastado,
        {half_up(f"CAST(sum({AMOUNT}) AS DOUBLE) / count(*)", 0)} AS ticket_promedio,
        min(o_orderdate) AS primera_compra, max(o_orderdate) AS ultima_compra
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'
    GROUP BY 1, 2, 3 ORDER BY total_gastado DESC, c_custkey LIMIT 20""",
)
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf).withColumnRenamed("o_custkey", "c_custkey")
    return as_double(
        analytics.top_customers(
            orders, table(spark, sf, "customer"), "c_custkey", ["c_name", "c_mktsegment"],
            "o_orderdate", "o_totalprice", "o_orderstatus", ["P"],
        )
    )


@query(
    "customer_cleanup",
    """SELECT c_custkey, coalesce(email, 'sin_email@placeholder.com') AS email, c_mktsegment AS estado,
        row_number() OVER (PARTITION BY email ORDER BY c_custkey) > 1 AS email_duplicado
    FROM (SELECT *, CASE WHEN c_custkey % 3 <> 0 THEN 'n' || c_nationkey || '@example.com' END AS email FROM customer) q
    WHERE c_mktsegment <> 'MACHINERY'""",
)
def customer_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the customers has no e-mail, the others share a few."""
    email = F.when(
        F.col("c_custkey") % 3 != 0, F.concat(F.lit("n"), F.col("c_nationkey"), F.lit("@example.com"))
    )
    people = table(spark, sf, "customer").select(
        "c_custkey", email.alias("email"), F.col("c_mktsegment").alias("estado")
    )
    return analytics.customer_cleanup(people, "c_custkey", "email", "estado", "MACHINERY")


@query(
    "fx_consolidation",
    """SELECT o_orderkey AS invoice_id, CAST(o_orderdate AS DATE) AS fecha,
        CASE WHEN o_orderstatus = 'F' THEN 'ARG' ELSE 'BRA' END AS pais,
        'P' || (o_orderkey % 10) AS producto_cod, l_lines AS cantidad, CAST(precio AS DOUBLE) AS precio_unit,
        moneda, 'Producto ' || (o_orderkey % 10) AS nombre,
        CAST(round(precio * a_usd, 4) AS DOUBLE) AS precio_unit_usd,
        CAST(round(l_lines * precio, 2) AS DOUBLE) AS venta_total_local,
        CAST(round(l_lines * precio * a_usd, 2) AS DOUBLE) AS venta_total_usd
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18, 4)) AS precio,
            CASE WHEN o_orderstatus = 'F' THEN 'ARS' ELSE 'BRL' END AS moneda,
            CASE WHEN o_orderstatus = 'F' THEN CAST(0.0011 AS DECIMAL(12, 6)) ELSE CAST(0.2 AS DECIMAL(12, 6)) END AS a_usd
        FROM orders JOIN (SELECT l_orderkey, count(*) AS l_lines FROM lineitem GROUP BY 1) q ON l_orderkey = o_orderkey) q""",
)
def fx_consolidation(spark: SparkSession, sf: str) -> DataFrame:
    """Two countries' sales with differently named columns, one rate table."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("units"))
    orders = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    shaped = orders.select(
        F.col("o_orderkey").alias("invoice_id"), F.col("o_orderdate").cast("date").alias("fecha"),
        F.concat(F.lit("P"), F.col("o_orderkey") % 10).alias("producto_cod"),
        F.col("units").alias("cantidad"), F.col("o_totalprice").alias("precio_unit"), "o_orderstatus",
    )
    argentina = shaped.where("o_orderstatus = 'F'").drop("o_orderstatus").withColumns(
        {"moneda": F.lit("ARS"), "pais": F.lit("ARG")}
    )
    brazil = shaped.where("o_orderstatus <> 'F'").drop("o_orderstatus").withColumns(
        {"moneda": F.lit("BRL"), "pais": F.lit("BRA")}
    )
    products = inline_relation(spark, ["producto_cod", "nombre"], [(f"P{i}", f"Producto {i}") for i in range(10)])
    rates = inline_relation(spark, ["moneda", "a_usd"], [("ARS", "0.0011"), ("BRL", "0.20")])
    return as_double(analytics.fx_consolidation([argentina, brazil], products, rates))


@query(
    "channel_monthly_kpis",
    f"""SELECT {MONTH} AS mes, o_orderstatus AS estado, count(*) AS total_pedidos,
        CAST(sum({AMOUNT}) AS DOUBLE) AS revenue_total, count(DISTINCT o_custkey) AS clientes_unicos,
        CAST(sum({AMOUNT}) AS DOUBLE) / count(*) AS ticket_promedio FROM orders GROUP BY 1, 2""",
)
def channel_monthly_kpis(spark: SparkSession, sf: str) -> DataFrame:
    padded = _orders(spark, sf).withColumn("o_orderstatus", F.concat(F.lit(" "), F.lower("o_orderstatus")))
    return as_double(
        analytics.channel_monthly_kpis(padded, "o_orderdate", "o_orderstatus", "o_totalprice", "o_custkey")
    )


@query(
    "untapped_markets",
    """WITH m AS (SELECT p_partkey AS ciudad, CAST(p_retailprice AS INTEGER) AS population, coalesce(n, 0) AS total_pedidos
        FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) q ON l_partkey = p_partkey)
    SELECT * FROM m WHERE population > 950 AND (total_pedidos = 0
        OR total_pedidos < (SELECT quantile_cont(total_pedidos, 0.05) FROM m))""",
)
def untapped_markets(spark: SparkSession, sf: str) -> DataFrame:
    """Parts stand in for cities: price as population, lines as orders."""
    sold = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("total_pedidos")
    )
    markets = table(spark, sf, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("ciudad"), F.rint("p_retailprice").cast("int").alias("population"), "total_pedidos"
    )
    return analytics.untapped_markets(materialise(markets, "markets"), 950)


SPAN = """o_orderdate >= DATE '{0}' AND o_orderdate < DATE '{1}'"""
NOW, BEFORE = SPAN.format("1998-07-01", "1998-09-29"), SPAN.format("1998-04-02", "1998-07-01")


def _change(now: str, before: str) -> str:
    return half_up(f"(CAST({now} AS DOUBLE) / {before} - 1) * 100", 2)


@query(
    "period_over_period",
    f"""SELECT *, {_change("pedidos_actual", "pedidos_anterior")} AS variacion_pedidos_pct,
        {_change("revenue_actual", "revenue_anterior")} AS variacion_revenue_pct,
        {_change("clientes_actual", "clientes_anterior")} AS variacion_clientes_pct
    FROM (SELECT count(*) FILTER ({NOW}) AS pedidos_actual, count(*) FILTER ({BEFORE}) AS pedidos_anterior,
        CAST(sum({AMOUNT}) FILTER ({NOW}) AS DOUBLE) AS revenue_actual,
        CAST(sum({AMOUNT}) FILTER ({BEFORE}) AS DOUBLE) AS revenue_anterior,
        count(DISTINCT o_custkey) FILTER ({NOW}) AS clientes_actual,
        count(DISTINCT o_custkey) FILTER ({BEFORE}) AS clientes_anterior FROM orders) q""",
)
def period_over_period(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(
        analytics.period_over_period(
            _orders(spark, sf), "o_orderdate", "o_totalprice", "o_custkey", "1998-07-01", 90
        )
    )


@query(
    "channel_share",
    f"""SELECT o_orderpriority, CAST(sum({AMOUNT}) AS DOUBLE) AS total_ventas,
        {half_up(f"CAST(sum({AMOUNT}) AS DOUBLE) * 100e0 / (SELECT CAST(sum({AMOUNT}) AS DOUBLE) FROM orders)", 2)} AS pct_participacion,
        count(*) AS n_pedidos FROM orders GROUP BY 1""",
)
def channel_share(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(analytics.channel_share(_orders(spark, sf), "o_orderpriority", "o_totalprice"))


@query(
    "geo_coverage",
    SALES
    + f"""
, by_province AS (
    SELECT plain AS provincia, count(*) AS pedidos, count(CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 1 END) AS geolocalizados
    FROM located GROUP BY 1
), both_levels AS (
    SELECT * FROM by_province
    UNION ALL SELECT 'TOTAL', CAST(sum(pedidos) AS BIGINT), CAST(sum(geolocalizados) AS BIGINT) FROM by_province
)
SELECT *, {half_up("geolocalizados * 100e0 / pedidos", 2)} AS geo_pct FROM both_levels""",
)
def geo_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are counted per customer before they meet the customer's place."""
    b = Bound(spark, sf)
    places = b.ubicacion_geo.withColumn("provincia", F.translate("provincia", "Á", "A"))
    counts = valid_orders(b.cliente_pedido, b.item_pedido).groupBy("cliente_id").agg(
        F.count(F.lit(1)).alias("orders")
    )
    located = counts.join(principal_location(b.cliente_ubicacion_geo), "cliente_id", "left").join(
        places, "ubicacion_id", "left"
    )
    return analytics.geo_coverage(located, "provincia", "latitud", "longitud", "orders")


@query(
    "status_mix",
    f"""WITH daily AS (
        SELECT CAST(ts AS DATE) AS fecha, CAST(user_id % 5 AS BIGINT) AS canal, count(*) AS pedidos,
            count(CASE WHEN event_type = 'error' THEN 1 END) AS observados FROM events GROUP BY 1, 2
    ), windowed AS (
        SELECT *, {half_up("sum(observados) OVER w * 100e0 / sum(pedidos) OVER w", 2)} AS pct_ventana FROM daily
        WINDOW w AS (PARTITION BY canal ORDER BY fecha RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
    )
    SELECT *, pct_ventana > 20 AS alerta FROM windowed""",
)
def status_mix(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("canal", F.col("user_id") % 5)
    return analytics.status_mix(events, "ts", "canal", "event_type", "error", alert_pct=20.0)


@query(
    "product_concentration",
    f"""WITH r AS (SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1),
    top AS (SELECT CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS s FROM (SELECT * FROM r ORDER BY revenue DESC, l_partkey LIMIT 3) q),
    everything AS (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS s FROM lineitem)
    SELECT l_partkey, revenue, {half_up("revenue * 100e0 / (SELECT max(revenue) FROM r)", 2)} AS pct_del_primero,
        {half_up("(SELECT s FROM top) * 100e0 / (SELECT s FROM everything)", 2)} AS pct_top FROM r""",
)
def product_concentration(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_partkey", money("l_extendedprice").alias("amount"))
    return as_double(analytics.product_concentration(lines, "l_partkey", "amount"))


@query(
    "delivery_density",
    BASE
    + """
SELECT r_name AS provincia, n_name AS ciudad, lat AS latitud, lon AS longitud, count(*) AS entregas
FROM base WHERE ch = 1 GROUP BY ALL
UNION ALL
SELECT CASE WHEN readable THEN r_name END, CASE WHEN readable THEN n_name END, NULL, NULL, count(*)
FROM base WHERE ch = 0 GROUP BY ALL""",
)
def delivery_density(spark: SparkSession, sf: str) -> DataFrame:
    points = staging.geo_envio(raw_tables(spark, sf, "vtex_pedido", "type_6", "meli_pickup"))
    return analytics.delivery_density(points)
